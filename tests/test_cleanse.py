"""Sources by configuration: a third source needs no code, copies keep their violations, 25 slots."""

from pyspark.sql import functions as F

from tidewater.operators.cleanse import Delimited, Slots, SourceConfig, cleanse, number_copies, violations_long


def test_third_source_by_configuration(spark):
    cfg = SourceConfig("east", roles={"Shop": "name", "Day": "date", "Post": "zip_or_longer"}, violations=Delimited("Notes", ";"),
                       id_column="Visit", make_id=True)
    row = (' "Ann\'s" ', "01/02/2020", "12345-99", "7. DIRT - Comments: x; 7. DIRT - Comments: a;;no code")
    df = spark.createDataFrame([row, row, (None, "bad", None, None)], "Shop string, Day string, Post string, Notes string")
    clean = cleanse(df, cfg)
    got = sorted(((r["Shop"], str(r["Day"]), r["Post"], r["source_city"]) for r in clean.collect()), key=str)
    assert got == sorted([("Ann's", "2020-01-02", "12345", "east")] * 2 + [(None, "None", None, "east")], key=str)
    assert clean.select("Visit").distinct().count() == 3
    v = [tuple(r)[1:] for r in violations_long(clean, cfg).collect()]
    assert sorted(v, key=str) == sorted([("7", "DIRT", "a", None, "east"), (None, "no code", "", None, "east")] * 2, key=str)


def test_all_25_slots_of_two_equal_rows(spark):
    cfg = SourceConfig("wide", roles={}, violations=Slots("V", "Text", points="Pts"), make_id=True)
    row = {"City": "x"} | {f"V_Text_{n}": f"*{n} Thing" if n != 4 else " " if n == 30 else "" for n in range(1, 26)} \
        | {f"V_Pts_{n}": str(n) if n % 2 else "bad" for n in range(1, 26)}
    df = spark.createDataFrame([tuple(row.values())] * 2, ", ".join(f"{c} string" for c in row))
    got = violations_long(cleanse(df, cfg), cfg)
    assert got.count() == 48 and got.select("Inspection_ID").distinct().count() == 2
    assert {(r["violation_code"], r["violation_points"]) for r in got.collect()} == {
        (str(n), n if n % 2 else None) for n in range(1, 26) if n != 4}
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().split("HashAggregate")[0]


def test_copies_of_one_row_are_spread(spark):
    """A third of all rows are one copy: each has its own id, and no task makes them all."""
    df = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 'same' ELSE concat('r', id div 2) END AS a", "CASE WHEN id % 3 = 0 THEN NULL ELSE 'x' END AS b")
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = number_copies(df, "id").withColumn("p", F.spark_partition_id())
        sizes = [r["n"] for r in got.where("a = 'same'").groupBy("p").agg(F.count("id").alias("n")).collect()]
        assert sum(sizes) == 10000 and max(sizes) <= 5000
        assert got.select("id").distinct().count() == 30000
        ids = {r["id"] for r in got.collect()}
        assert ids == {r["id"] for r in number_copies(df.repartition(3), "id").collect()}
    finally:
        for c, x in before.items():
            spark.conf.set(c, x)


def test_rows_without_a_copy_are_not_shuffled(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    out = number_copies(df, "id")
    assert out.count() == len({r["id"] for r in out.collect()}) == 200
    assert "hashpartitioning" not in out._jdf.queryExecution().executedPlan().executedPlan().toString()
    twice = number_copies(df.unionByName(df.where("a < 5")).unionByName(spark.createDataFrame([(None, "x"), (None, "x")], "a string, b string")), "id")
    assert twice.count() == len({r["id"] for r in twice.collect()}) == 207
    assert {r["id"] for r in out.collect()} <= {r["id"] for r in twice.collect()}


def test_more_shared_hashes_than_a_broadcast_takes(spark, monkeypatch):
    """Rows without a copy stay unshuffled then too; a full bitmap only has more rows grouped."""
    from tidewater.operators import cleanse as C
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 500).otherwise(F.col("id")).cast("string").alias("a"),
                                  F.when(F.col("id") % 7 > 0, F.lit("x")).alias("b"))
    want = {r["id"] for r in number_copies(df, "id").collect()}
    assert len(want) == 3000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        out = number_copies(df, "id")
        assert "SortMergeJoin" not in out._jdf.queryExecution().executedPlan().toString()
        assert {r["id"] for r in out.collect()} == want
        hashes = df.select(F.xxhash64("a").alias("h")).where("a < '2'")
        flagged = C._may_be_in(df.withColumn("h", F.xxhash64("a")), hashes, "h", "f")
        assert flagged.columns == ["a", "b", "h", "f"] and flagged.where("a < '2' and not f").count() == 0 < flagged.where("not f").count()
        monkeypatch.setattr(C, "MOST_BITS", 8)
        assert {r["id"] for r in number_copies(df, "id").collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_rules_are_one_predicate(spark):
    from tidewater.operators.quality import Rule, apply_rules
    df = spark.createDataFrame([(1, 1), (1, None), (None, 1), (0, 1)], "a int, b int")
    kept = apply_rules(df, [Rule("a", F.col("a") == 1), Rule("b", F.col("b") == 1)])
    assert "forall" in kept._jdf.queryExecution().optimizedPlan().toString()
    assert [tuple(r) for r in kept.collect()] == [(1, 1)]
