"""Checks read from metadata: validation, row and dataset checks, and keys that hold a third of all rows."""

import json

import pytest
from pyspark.sql import functions as F

from tidewater.operators import checks as K
from tidewater.operators.skew import join_counted

ROWS = [(1, "a", "x", 5, "2024-01-01"), (2, "a", None, 50, "bad"), (3, "b", "", -1, None), (3, "b", "y", None, "2024-02-30"),
        (None, "c", " ", 7, "2024-02-28"), (None, "c", "x", 8, "x")]
SCHEMA = "id int, grp string, txt string, num int, day string"


def check(function, name=None, criticality="error", filter=None, **arguments):
    out = {"name": name or function, "criticality": criticality, "check": {"function": function, "arguments": arguments}}
    return out | ({"filter": filter} if filter else {})


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def failing(df, one, refs=None):
    marked = K.annotate(df, [one], refs).where(F.size("_errors") > 0)
    return sorted(((r["id"], r["grp"], r["num"]) for r in marked.collect()), key=str)


def at(*places):
    return sorted(((ROWS[i][0], ROWS[i][1], ROWS[i][3]) for i in places), key=str)


@pytest.mark.parametrize("one, rows", [
    (check("is_not_null", column="id"), (4, 5)), (check("is_not_empty", column="txt"), (2,)),
    (check("is_not_null_and_not_empty", column="txt"), (1, 2)), (check("is_not_null_and_not_empty", column="txt", trim_strings=True), (1, 2, 4)),
    (check("is_in_list", column="txt", allowed=["x", "y"]), (2, 4)), (check("is_not_null_and_is_in_list", column="txt", allowed=["x", "y"]), (1, 2, 4)),
    (check("is_in_range", column="num", min_limit=0, max_limit=10), (1, 2)), (check("is_not_in_range", column="num", min_limit=0, max_limit=10), (0, 4, 5)),
    (check("is_not_less_than", column="num", limit=7), (0, 2)), (check("is_not_greater_than", column="num", limit=7), (1, 5)),
    (check("regex_match", column="txt", regex="^[xy]$"), (2, 4)), (check("regex_match", column="txt", regex="^[xy]$", negate=True), (0, 3, 5)),
    (check("is_valid_date", column="day"), (1, 3, 5)), (check("is_valid_timestamp", column="day"), (1, 3, 5)),
    (check("sql_expression", expression="num > id"), (2, 3, 4, 5)), (check("is_not_null", column="id", filter="txt = 'x'"), (5,)),
    (check("is_unique", columns=["id"]), (2, 3)), (check("is_unique", columns=["id"], nulls_distinct=False), (2, 3, 4, 5)),
    (check("is_unique", columns=["id", "txt"]), ()), (check("is_unique", columns=["grp"], filter="num > 6"), (4, 5)),
    (check("is_aggr_not_greater_than", column="num", limit=14, aggr_type="sum", group_by=["grp"]), (0, 1, 4, 5)),
    (check("is_aggr_not_less_than", column="num", limit=2, group_by=["grp"]), (2, 3)),
    (check("is_aggr_not_greater_than", column="*", limit=5), (0, 1, 2, 3, 4, 5)), (check("is_aggr_not_greater_than", column="*", limit=6), ()),
    (check("is_aggr_not_less_than", column="id", limit=4, aggr_type="count_distinct"), (0, 1, 2, 3, 4, 5)),
])
def test_each_function(df, one, rows):
    assert failing(df, one) == at(*rows)


def test_foreign_key(spark, df):
    refs = {"known": spark.createDataFrame([(1, "a"), (1, "a"), (3, "z"), (None, "c")], "rid int, rg string")}
    assert failing(df, check("foreign_key", columns=["id"], ref_columns=["rid"], ref_df_name="known"), refs) == at(1)
    assert failing(df, check("foreign_key", columns=["id", "grp"], ref_columns=["rid", "rg"], ref_df_name="known"), refs) == at(1, 2, 3)
    assert failing(df, check("foreign_key", columns=["id"], ref_columns=["rid"], ref_df_name="known", filter="num is null"), refs) == at()


def test_split_from_json_and_order_of_names(df):
    meta = [check("is_not_null", "id_known", column="id"), check("is_unique", "grp_once", "warn", columns=["grp"]),
            check("is_in_range", "num_fits", column="num", min_limit=0, max_limit=9), check("is_unique", "id_once", columns=["id"])]
    valid, quarantine = K.split_by_metadata(df, json.dumps(meta))
    assert valid.columns == df.columns and [r["num"] for r in valid.collect()] == [5]
    assert sorted((str(r["num"]), r["_errors"], r["_warnings"]) for r in quarantine.collect()) == sorted([
        ("5", [], ["grp_once"]), ("50", ["num_fits"], ["grp_once"]), ("-1", ["num_fits", "id_once"], ["grp_once"]),
        ("None", ["id_once"], ["grp_once"]), ("7", ["id_known"], ["grp_once"]), ("8", ["id_known"], ["grp_once"])])
    assert K.annotate(df.limit(0), meta).collect() == []


@pytest.mark.parametrize("meta, said", [
    ([check("is_nice", column="id")], "unknown function 'is_nice'"), ([check("is_not_null", column="nope")], "no column \\['nope'\\]"),
    ([check("is_not_null")], "missing a required argument"), ([check("is_not_null", column="id", more=1)], "unexpected keyword"),
    ([check("is_not_null", criticality="fatal", column="id")], "criticality 'fatal'"), ([{"name": "x"}], "expected a dict"),
    ([check("is_not_null", "x", column="id")] * 2, "name 'x' is taken"), ([check("is_unique", columns=["id", "nope"])], "no column"),
    ([check("foreign_key", columns=["id"], ref_columns=["id"], ref_df_name="gone")], "no reference frame 'gone'"),
    ([check("is_aggr_not_less_than", column="id", limit=1, aggr_type="mode")], "unknown aggregate"),
    ([check("is_not_null", column="id") | {"severity": 1}], "unknown fields")])
def test_what_does_not_fit_raises(df, meta, said):
    with pytest.raises(ValueError, match=said):
        K.bind(meta, df)


def test_a_hot_key_is_not_joined_in_one_task(spark):
    """One key with a third of all rows, NULL with another: the rows of neither meet in one task."""
    rows = spark.range(24000).select("id", F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('k', id div 6) END").alias("k"))
    keyed = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.concat(F.lit("v-"), F.coalesce("k", F.lit("null"))))
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = join_counted(rows, keyed, ["k"], "n", "v")
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("v").alias("n")).collect()]
        assert len(sizes) == 16 and sum(sizes) == 24000 and max(sizes) < 3000
        assert got.where(~F.col("v").eqNullSafe(F.concat(F.lit("v-"), F.coalesce("k", F.lit("null"))))).count() == 0
    finally:
        for c, x in before.items():
            spark.conf.set(c, x)


def test_one_aggregate_for_a_grain(df):
    """Two checks on one grain read the rows once."""
    meta = [check("is_unique", "u", columns=["grp"]), check("is_aggr_not_less_than", "a", column="num", limit=2, group_by=["grp"])]
    keys = K._failing_keys(df, dict(enumerate(K.bind(meta, df))), ("grp",), {})
    plan = keys._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan
    assert {r["grp"]: r["_keys_failed"] for r in keys.collect()} == {"a": [0], "b": [0, 1], "c": [0]}
