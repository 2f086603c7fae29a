"""Sketch profiles, exact top-k, the report cube, checked CSV, observed counts and the load decision."""

import datetime as dt
import os
import random
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F

from tidewater import sinks
from tidewater.operators import profile as P
from tidewater.operators import reports as R
from tidewater.operators import sketches as K
from tidewater.plans import pipeline
from tidewater.sources.csv import read_csv_checked, string_schema


def test_merged_sketches_equal_one_pass_and_are_close_to_exact(spark):
    df = spark.range(40000).select((F.col("id") % 9000).alias("a"), F.when(F.col("id") % 4 > 0, F.sqrt("id")).alias("b"), F.concat(F.lit("v"), F.col("id") % 50).alias("c"),
                                   F.lit(None).cast("double").alias("empty"), (F.col("id") % 6).alias("day"))
    daily = K.sketch_profile(df, by=["day"])
    merged = {r["column_name"]: r for r in K.estimates(K.merge_profiles(daily)).collect()}
    once = {r["column_name"]: r for r in K.estimates(K.sketch_profile(df.drop("day"))).collect()}
    assert set(merged) == set(once) == {"a", "b", "c", "empty"}
    for c, r in merged.items():
        exact = df.select(c).where(F.col(c).isNotNull()).distinct().count()
        assert (r["total_rows"], r["null_count"], r["distinct_estimate"]) == tuple(once[c][x] for x in ("total_rows", "null_count", "distinct_estimate"))
        assert abs(r["distinct_estimate"] - exact) <= 0.05 * exact
    assert merged["empty"]["quantiles"] is None and merged["c"]["quantiles"] is None and merged["b"]["null_pct"] == 25
    for q, x in zip((0.25, 0.5, 0.75), merged["b"]["quantiles"]):
        assert abs(df.where(F.col("b") <= x).count() / 30000 - q) < 0.03


def test_drift(spark):
    a = spark.range(5000).select(F.col("id").alias("x"), F.col("id").alias("y"), F.lit("s").alias("z"))
    b = spark.range(5000).select((F.col("id") * 2).alias("x"), F.when(F.col("id") % 2 == 0, F.col("id")).alias("y"), F.concat(F.lit("s"), F.col("id") % 4).alias("z"))
    got = {r["column_name"]: r for r in K.drift(K.sketch_profile(a), K.sketch_profile(b)).collect()}
    assert abs(got["x"]["rank_shift"] - 0.48) < 0.05 and got["y"]["rank_shift"] < 0.04 and got["z"]["rank_shift"] is None
    assert got["y"]["null_pct_change"] == 50 and abs(got["z"]["distinct_ratio"] - 4) < 0.1


@pytest.mark.parametrize("buckets", [1, 7, 1 << 16])
@pytest.mark.parametrize("kind", ["few", "near_unique", "unique", "nulls", "none"])
def test_topk_exact_equals_topk(spark, kind, buckets):
    rng = random.Random(3)
    values = {"few": [rng.randrange(4) for _ in range(500)], "near_unique": list(range(600)) + [5, 5, 7, 900, 900], "unique": list(range(300)),
              "nulls": [None] * 40 + list(range(50)) * 2, "none": []}[kind]
    rng.shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int")
    got = [tuple(r) for r in P.topk_exact(df, "v", 10, buckets=buckets).collect()]
    assert got == [tuple(r) for r in P.topk_freq(df, "v", 10).collect()]


def test_cube_slices_are_the_reports(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["r1", "r2", None]), rng.choice(["t1", "t2"]), rng.choice([20200101, 20210305, None]), rng.choice(["n", "s"]), rng.choice(["Pass", "Fail", None]),
             rng.choice([None, 3, 88, 90])) for _ in range(300)]
    fact = spark.createDataFrame(rows, "restaurant_key string, inspection_type_key string, date_key int, source_city string, inspection_result string, inspection_score int")
    dim = spark.createDataFrame([("r1", "Risk 1", "Bar"), ("r2", None, "Bar")], "restaurant_key string, risk_category string, facility_type string")
    typ = spark.createDataFrame([("t1", "a", "n"), ("t2", None, "s")], "inspection_type_key string, inspection_type_name string, source_city string")
    cube = R.report_cube(fact, dim, typ)
    told = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    assert told(R.cube_slice(cube, "total")) == [(300,)]
    assert told(R.cube_slice(cube, "results_by_group")) == told(R.results_by_group(fact))
    assert told(R.cube_slice(cube, "by_year")) == told(R.by_year(fact))
    assert told(R.cube_slice(cube, "risk")) == told(R.risk_share(fact, dim).select("risk_category", "inspections"))
    assert told(R.cube_slice(cube, "facility")) == told(R.top_facility_types(fact, dim))
    got = R.cube_slice(cube, "score").where("source_city = 'n' and score_bucket is not null").select("score_bucket", "inspections")
    assert told(got) == told(R.score_histogram(fact, 5, "n"))
    plan = cube._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 3


def test_checked_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,name,note\n1,one,x\n2,two\n3,three,y,more\n4,"fo\nur ""4""",\n5,"open,z\n6,lost,in the quote\n')
    (tmp_path / "b.csv").write_text("id,name,note\n7,seven,z\n")
    schema = string_schema(["id", "name", "note"])
    got = read_csv_checked(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema)
    assert sorted(tuple(r) for r in got.rows.collect()) == [("1", "one", "x"), ("4", 'fo\nur "4"', None), ("7", "seven", "z")]
    bad = sorted(r["record"] for r in got.bad.collect())
    assert [b[0] for b in bad] == ["2", "3", "5"] and "6,lost" in bad[2]
    assert sorted((r["file"].rsplit("/", 1)[1], r["seen"], r["kept"], r["quarantined"]) for r in got.counts.collect()) == [("a.csv", 5, 2, 3), ("b.csv", 1, 1, 0)]
    line = read_csv_checked(spark, str(tmp_path / "a.csv"), schema, multiline=False)
    assert [r["id"] for r in line.rows.collect() if r["id"] == "6"] == ["6"] and any(r["record"].startswith('5,"open') for r in line.bad.collect())


def test_observed_counts_equal_scans(spark, tmp_path):
    cfg = pipeline.default_config(spark, base=str(tmp_path / "lake"), as_of=dt.date(2001, 12, 1))
    counts: dict = {}
    paths = pipeline.run(spark, "/root/testdata/sf0.001", cfg, counts)
    seen = {r["table_name"]: r["row_count"] for r in pipeline.row_counts(spark, paths, counts).collect()}
    assert seen == {r["table_name"]: r["row_count"] for r in pipeline.row_counts(spark, paths).collect()}
    assert sum(p in counts for p in paths.values()) == len(paths) - 1      # all but the type-2 table, whose log has its counts
    from tidewater.operators import quality as Q
    from tidewater.plans import silver as V
    for name, rules in (("north", V.north_rules()), ("south", V.south_rules())):
        written = spark.read.parquet(f"{cfg.layer('silver')}/{name}_rules_audit")
        scanned = Q.audit_from_flags(spark.read.parquet(f"{cfg.layer('silver')}/{name}_flagged"), rules)
        assert sorted(tuple(r) for r in written.collect()) == sorted(tuple(r) for r in scanned.select(*written.columns).collect())


def test_a_retried_task_counts_once(tmp_path):
    code = f"""
        import sys; sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark import TaskContext
        from pyspark.sql import functions as F
        from tidewater.session import get_spark
        from tidewater.sinks import write_table
        spark = get_spark("local[2,4]", 2)
        def once(batches):
            for b in batches:
                yield b
            if TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() == 1:
                raise RuntimeError("lost")
        counts = {{}}
        df = spark.range(1000, numPartitions=4).mapInPandas(once, "id bigint")
        path = write_table(df, {str(tmp_path / 't')!r}, counts=counts, metrics={{"total": F.sum("id")}})
        assert counts[path] == {{"row_count": 1000, "total": 499500}}, counts
        assert spark.read.parquet(path).count() == 1000
        print("counted once")
    """
    out = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=200)
    assert "counted once" in out.stdout, out.stderr[-2000:]


def test_load_mode(spark):
    name = "probe_dim_table"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert sinks.load_mode(spark, name) == "first_load"
    spark.range(3).write.format("json").saveAsTable(name)
    assert sinks.load_mode(spark, name) == "first_load" and not spark.catalog.tableExists(name)   # a foreign format is dropped
    sinks.save_as_table(spark.range(3).toDF("id"), name)
    assert sinks.load_mode(spark, name) == "merge" and spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def test_profile_report_is_the_single_reports(spark):
    rng = random.Random(8)
    rows = [(rng.choice([None, "", "a", "b"]), rng.choice([None, 9.0, 10.0, 100.0, -0.0, 0.0, 9.0]), rng.choice([None, 50, 95]), rng.choice([None, "x"]), "y") for _ in range(200)]
    df = spark.createDataFrame(rows, "t string, d double, s int, v1 string, v2 string")
    got = P.profile_report(df, ["t", "d", "s"], frequencies=["d", "t"], top=3, numeric=["s"], score="s", slots=["v1", "v2"], rows={"high": F.col("s") > 90})
    told = {}
    for r in got.collect():
        told.setdefault((r["column_name"], r["metric"]), []).append((r["label"], r["value"]))
    for r in P.profile(df, ["t", "d", "s"]).collect():
        for m in ("total_rows", "null_count", "distinct_count"):
            assert told[r["column_name"], m] == [(None, float(r[m]))]
        assert told[r["column_name"], "null_pct"] == [(None, round(r["null_pct"], 2))]
    plain = F.col("d") + 0.0
    assert sorted(told["d", "frequency"], key=str) == sorted(((r["v"], float(r["count"])) for r in P.topk_freq(df, plain, 3).select(F.col("value").cast("string").alias("v"), "count").collect()), key=str)
    assert sorted(told["t", "frequency"], key=str) == sorted(((r["value"], float(r["count"])) for r in P.topk_freq(df, "t", 3).collect()), key=str)
    assert sorted(told["s", "bin"], key=str) == sorted(((r["score_bin"], float(r["count"])) for r in P.binned_distribution(df, "s").collect()), key=str)
    assert dict(told["slots", "rows_by_filled"]) == {str(r["f"]): float(r["count"]) for r in P.nonblank_histogram(df, ["v1", "v2"], "f").collect()}
    assert told["*", "rows_where"] == [("high", float(sum(r[2] == 95 for r in rows)))]
    for r in P.numeric_summary(df, ["s"]).collect():
        assert told["s", r["metric"]] == [(None, r["value"])]
    assert P.profile_report(df, ["t"]).count() == 4
