"""Type-2 history from many snapshots, and as-of lookups against it."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidewater.operators import scd2 as S
from tidewater.operators import star as ST
from tidewater.operators.asof import as_of_lookup

KEYS = ["restaurant_name", "source_city", "license_number"]
TRACKED = ["facility_type", "risk_category", "aka_name"]
SCHEMA = ("restaurant_name string, aka_name string, license_number string, facility_type string, "
          "risk_category string, source_city string")
FAR = dt.date(9999, 12, 31)


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def some_snapshots(rng, count):
    """Keys that stay, change, change back, vanish and return; NULL and blank values; keys that match nothing."""
    days = sorted(rng.choices(range(0, 12), k=count))   # some share a day
    out = []
    for i, n in enumerate(days):
        rows = []
        for name in "ABCDEFGH":
            if rng.random() < .7:
                rows.append((name, rng.choice([None, "", "x"]), rng.choice([None, "1"]) if name > "D" else "1",
                             rng.choice(["Bar", "Cafe"]), rng.choice(["Risk 1", None]), "C"))
        if rng.random() < .5:
            rows.append((None, None, None, "Bar", "Risk 1", "C"))
        rows = list({(r[0], r[2] or ""): r for r in rows}.values())
        out.append((day(n), dt.datetime(2024, 1, 1, 6) + dt.timedelta(hours=i), f"job{i % 3}", rows))
    return out


def folded(spark, snapshots, dim=None):
    for as_of, ts, job, rows in snapshots:
        dim = S.scd2_merge(dim, spark.createDataFrame(rows, SCHEMA), KEYS, TRACKED, as_of, ts, job, nullable=["license_number"], validate=False)
    return dim


def all_rows(spark, snapshots):
    flat = [(*r, a, t, j) for a, t, j, rows in snapshots for r in rows]
    return spark.createDataFrame(flat, SCHEMA + ", as_of date, run_ts timestamp, job_id string")


def told(df, cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_equals_merging_one_by_one(spark, seed):
    snaps = some_snapshots(random.Random(seed), 4)
    want = folded(spark, snaps)
    got = S.scd2_from_snapshots(all_rows(spark, snaps).repartition(3), KEYS, TRACKED, nullable=["license_number"])
    assert told(got, want.columns) == told(want, want.columns)


def test_one_pass_goes_on_from_a_dimension(spark):
    snaps = some_snapshots(random.Random(9), 5)
    base = folded(spark, snaps[:2])
    want = folded(spark, snaps)
    got = S.scd2_from_snapshots(all_rows(spark, snaps[2:]), KEYS, TRACKED, dim=base, nullable=["license_number"])
    assert told(got, want.columns) == told(want, want.columns)
    checks = {r["check_name"]: r["passed"] for r in S.scd2_checks(got.where("restaurant_name is not null"), KEYS, ["license_number"]).collect()}
    assert all(checks.values())


def brute_as_of(facts, versions, backdate):
    out = []
    for fid, key, d in facts:
        mine = sorted(v for v in versions if v[0] == key and key is not None and (v[3] or v[1] < v[2]))
        hit = [v for v in mine if d is not None and v[1] <= d and (v[3] or d < v[2])]
        if not hit and backdate and mine and d is not None and d < mine[0][1]:
            hit = mine[:1]
        out.append((fid, key, d, hit[-1][4] if hit else None))
    return sorted(out, key=str)


def version_rows(rng):
    rows = []
    for key in ["hot", "k1", "k2", "k3", "gone"]:
        at = day(rng.randrange(-40, 10))
        for i in range(30 if key == "hot" else 5):
            step = rng.choice([0, 0, 1, 5, 40])                  # same-day changes too
            end = at + dt.timedelta(days=step)
            rows.append((key, at, end, False, f"{key}-{i}"))
            at = end + dt.timedelta(days=rng.choice([0, 0, 3]))   # and gaps
        if key != "gone":
            rows.append((key, at, FAR, True, f"{key}-last"))
    return rows


@pytest.mark.parametrize("backdate", [False, True])
@pytest.mark.parametrize("slice_days", [1, 32])
def test_as_of_matches_brute_force(spark, backdate, slice_days):
    rng = random.Random(slice_days)
    versions = version_rows(rng)
    edges = [v[1] for v in versions] + [v[2] for v in versions if v[2] != FAR]    # days of change and their neighbours
    facts = [(i, rng.choice(["hot", "hot", "k1", "k2", "k3", "gone", "none", None]),
              rng.choice([rng.choice(edges) + dt.timedelta(days=rng.choice([-1, 0, 1])), day(rng.randrange(-99, 900)), None])) for i in range(600)]
    f = spark.createDataFrame(facts, "id int, name string, d date")
    v = spark.createDataFrame(versions, "name string, effective_start_date date, effective_end_date date, is_current boolean, restaurant_key string")
    got = as_of_lookup(f, v, [(F.col("name"), F.col("name"))], "d", ["restaurant_key"], backdate=backdate, slice_days=slice_days)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_as_of(facts, versions, backdate)
    assert as_of_lookup(f.limit(0), v, [(F.col("name"), F.col("name"))], "d", ["restaurant_key"]).collect() == []
    assert all(r["restaurant_key"] is None for r in as_of_lookup(f, v.limit(0), [(F.col("name"), F.col("name"))], "d", ["restaurant_key"]).collect())


def test_a_hot_key_is_spread_over_its_dates(spark):
    """A third of all facts, and all facts that match nothing, on one key each: no task gets them all."""
    f = spark.range(30000).select("id", F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE concat('k', id % 500) END").alias("name"),
                                  F.expr("date_add(date'2020-01-01', int(id % 2000))").alias("d"))
    v = spark.createDataFrame([("hot", day(-9), FAR, True, "h")], "name string, effective_start_date date, effective_end_date date, is_current boolean, k string")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = as_of_lookup(f, v, [(F.col("name"), F.col("name"))], "d", ["k"])
        sizes = [r["n"] for r in got.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count("k")).collect()]
        assert sum(sizes) == 30000 and max(sizes) < 6000
        assert got.where("k = 'h'").count() == 10000
    finally:
        for c, x in before.items():
            spark.conf.set(c, x)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_as_of_reads_the_columns_it_needs_and_finds_slices_once(spark, tmp_path):
    """facts a month apart share a slice; columns that nobody asks for are not read; rows that match nothing are not dealt."""
    facts = [(i, f"k{i % 5}" if i % 7 else None, day(32 * (i // 5)) if i % 11 else None, "x" * 50) for i in range(55)]
    spark.createDataFrame(facts, "id int, name string, d date, other string").write.parquet(str(tmp_path / "facts"))
    f = spark.read.parquet(str(tmp_path / "facts"))
    versions = [(f"k{i}", day(0), FAR, True, f"v{i}") for i in range(5)]
    v = spark.createDataFrame(versions, "name string, effective_start_date date, effective_end_date date, is_current boolean, k string")
    got = as_of_lookup(f, v, [(F.col("name"), F.col("name"))], "d", ["k"])
    assert "other" not in plan_of(got.select("id", "k"))
    assert "SortAggregate" not in plan_of(got)          # no greatest array by sorting
    assert sorted((tuple(r) for r in got.select("id", "name", "d", "k").collect()), key=str) == brute_as_of([r[:3] for r in facts], versions, False)
    assert got.columns == ["id", "name", "d", "other", "k"] and got.where("k IS NULL AND other = repeat('x', 50)").count() == 12


def test_fact_takes_the_version_of_its_date(spark):
    dim = folded(spark, [(day(0), dt.datetime(2024, 1, 1), "a", [("A", None, None, "Bar", "Risk 1", "C")]),
                         (day(10), dt.datetime(2024, 1, 2), "b", [("A", None, None, "Cafe", "Risk 1", "C")])])
    rows = [(str(i), "A", lic, "C", "s", "c", "st", "z", "t", d, "Pass", 90) for i, (lic, d) in enumerate(
        [(None, day(-5)), ("", day(9)), (None, day(10)), (None, day(99)), ("9", day(3)), (None, None)])]
    insp = spark.createDataFrame(rows, "inspection_id string, restaurant_name string, license_number string, source_city string, address string, city string, "
                                 "state string, zip string, inspection_type string, inspection_date date, inspection_result string, inspection_score int")
    names = {r["restaurant_key"]: r["facility_type"] for r in dim.collect()}
    fact = ST.load_fact(insp, dim, lookup="hash", as_of_date=True)
    assert {r["inspection_id"]: names.get(r["restaurant_key"]) for r in fact.collect()} == {
        "0": "Bar", "1": "Bar", "2": "Cafe", "3": "Cafe", "4": None, "5": None}


def merged(spark, base, as_of, rows):
    from tidewater.sources.tables import read_history
    return S.scd2_merge(read_history(spark, base, current_only=True), spark.createDataFrame(rows, SCHEMA), KEYS, TRACKED, as_of,
                        dt.datetime(2024, 1, 1), "j", nullable=["license_number"])


def test_append_only_history(spark, tmp_path, monkeypatch):
    from tidewater import sinks
    from tidewater.sources.tables import HISTORY, current_version, history_log, read_history, read_table
    base = str(tmp_path / "dim")
    assert read_history(spark, base) is None
    batches = [[("A", None, "1", "Bar", None, "C"), ("B", None, None, "Bar", None, "C")], [("A", None, "1", "Cafe", None, "C")],
               [("A", None, "1", "Cafe", "", "C")], [("A", None, "1", "Bar", None, "C"), ("B", "b", "", "Bar", None, "C")]]
    want = None
    for i, rows in enumerate(batches):
        want = S.scd2_merge(want, spark.createDataFrame(rows, SCHEMA), KEYS, TRACKED, day(i), dt.datetime(2024, 1, 1), "j", nullable=["license_number"])
        before = history_log(spark, base).collect() if i else []
        assert sinks.write_history(spark, merged(spark, base, day(i), rows), base) == i + 1
        got = read_history(spark, base)
        assert got.columns == want.columns and told(got, want.columns) == told(want, want.columns)
        assert set(before) < set(history_log(spark, base).collect())
    assert sorted((r["version"], r["current_rows"], r["closed_rows"]) for r in history_log(spark, base).collect()) == [(1, 2, 0), (2, 2, 1), (3, 2, 0), (4, 2, 2)]
    assert told(read_table(spark, HISTORY + base), want.columns) == told(want, want.columns)
    assert told(read_history(spark, base, version=2), want.columns) == told(folded(spark, [(day(i), dt.datetime(2024, 1, 1), "j", batches[i]) for i in (0, 1)]), want.columns)
    with pytest.raises(ValueError, match="no version 9"):
        read_history(spark, base, version=9)

    def crash(*_):
        raise RuntimeError("lost the driver")
    with monkeypatch.context() as m:   # between the data and the log entry
        m.setattr(sinks, "_commit", crash)
        with pytest.raises(RuntimeError):
            sinks.write_history(spark, merged(spark, base, day(9), batches[1]), base)
    assert current_version(spark, base) == 4 and told(read_history(spark, base), want.columns) == told(want, want.columns)
    assert sinks.write_history(spark, merged(spark, base, day(9), batches[1]), base) == 5
    assert [r["closed_rows"] for r in history_log(spark, base).where("version = 5").collect()] == [1]


def test_append_only_history_of_nothing(spark, tmp_path):
    from tidewater import sinks
    from tidewater.sources.tables import read_history
    base = str(tmp_path / "dim")
    for _ in range(2):
        sinks.write_history(spark, merged(spark, base, day(0), []), base)
    assert read_history(spark, base).collect() == []
    sinks.write_history(spark, merged(spark, base, day(1), [("A", None, "1", "Bar", None, "C")]), base)
    assert read_history(spark, base).count() == 1
