"""SCD2 scenarios (FIXTURES §5) and star-schema fan-out guards (FIXTURES §6)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.operators import dims as D
from tidewater.operators import scd2 as S
from tidewater.operators import star as ST

KEYS = ["restaurant_name", "source_city", "license_number"]
TRACKED = ["facility_type", "risk_category", "aka_name"]
SCHEMA = ("restaurant_name string, aka_name string, license_number string, facility_type string, "
          "risk_category string, source_city string")
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
TS = dt.datetime(2024, 1, 1, 6)


def merge(spark, dim, data, day, job="j"):
    stg = spark.createDataFrame(data, SCHEMA)
    return S.scd2_merge(dim, stg, KEYS, TRACKED, day, TS, job, nullable=["license_number"])


BASE = [("A", None, "1", "Bakery", "Risk 1", "C"), ("B", "bee", None, "Cafe", "Risk 2", "C"),
        ("C", None, "3", "Bar", "Risk 3", "D")]


def state(dim):
    return sorted((r["restaurant_name"], r["facility_type"], r["risk_category"], r["aka_name"],
                   r["effective_start_date"], r["effective_end_date"], r["is_current"]) for r in dim.collect())


def test_initial_load(spark):
    dim = merge(spark, None, BASE, D1)
    assert dim.count() == 3
    assert all(r["is_current"] and r["effective_end_date"] == dt.date(9999, 12, 31) for r in dim.collect())


def test_one_change_two_changes_insert_and_noop(spark):
    dim = merge(spark, None, BASE, D1)
    changed = [("A", None, "1", "SCD2_TEST_BAKERY", "Risk 1", "C"),            # one attribute
               ("B", "SCD2_TEST_AKA_NAME", None, "Cafe", "Risk 3 (Low)", "C"),   # two attributes, NULL licence
               ("C", None, "3", "Bar", "Risk 3", "D"),                           # unchanged
               ("N", None, "9999999", "New", "Risk 1", "C")]                     # insert
    dim2 = merge(spark, dim, changed, D2)
    st = state(dim2)
    assert len(st) == 6
    assert ("A", "Bakery", "Risk 1", None, D1, D2, False) in st
    assert ("A", "SCD2_TEST_BAKERY", "Risk 1", None, D2, dt.date(9999, 12, 31), True) in st
    assert sum(1 for r in st if r[0] == "B") == 2
    assert ("N", "New", "Risk 1", None, D2, dt.date(9999, 12, 31), True) in st
    # identical staging again: no change
    dim3 = merge(spark, dim2, changed, D3)
    assert state(dim3) == st
    cmp = S.scd2_compare_totals(dim2, dim3).first()
    assert cmp["unchanged"]


def test_null_vs_empty_is_no_change_and_missing_key_stays(spark):
    dim = merge(spark, None, BASE, D1)
    stg = [("A", "", "1", "Bakery", "Risk 1", "C")]        # aka NULL -> '' ; B and C missing
    dim2 = merge(spark, dim, stg, D2)
    assert state(dim2) == state(dim)


def test_two_changes_same_day_and_checks(spark):
    dim = merge(spark, None, BASE, D1)
    dim = merge(spark, dim, [("A", None, "1", "X", "Risk 1", "C")], D2, "j2")
    dim = merge(spark, dim, [("A", None, "1", "Y", "Risk 1", "C")], D2, "j3")
    a = [r for r in state(dim) if r[0] == "A"]
    assert len(a) == 3 and sum(r[-1] for r in a) == 1
    checks = {r["check_name"]: r["failures"] for r in S.scd2_checks(dim, KEYS, ["license_number"]).collect()}
    assert set(checks.values()) == {0}
    detail = S.scd2_change_detail(dim, KEYS, TRACKED, ["license_number"]).collect()
    assert [(r["old_facility_type"], r["new_facility_type"]) for r in detail] == [("X", "Y")]


def test_duplicate_staging_key_rejected(spark):
    with pytest.raises(ValueError):
        merge(spark, None, [BASE[0], BASE[0]], D1)


def test_as_of_resolves_change_day_to_new_version(spark):
    dim = merge(spark, None, BASE, D1)
    dim = merge(spark, dim, [("A", None, "1", "X", "Risk 1", "C")], D2)
    on_change = S.as_of(dim.filter(F.col("restaurant_name") == "A"), D2).collect()
    assert [r["facility_type"] for r in on_change] == ["X"]
    before = S.as_of(dim.filter(F.col("restaurant_name") == "A"), dt.date(2024, 1, 15)).collect()
    assert [r["facility_type"] for r in before] == ["Bakery"]


def test_star_has_no_fan_out(spark):
    insp = spark.createDataFrame([
        (1, "R", None, "C", "1 MAIN", "X", "S", "00001", 1.0, 2.0, dt.date(2024, 1, 1), "T", "Pass", 90),
        (2, "R", None, "C", "1 MAIN", "X", "S", "00001", 1.5, 2.5, dt.date(2024, 1, 2), "T", "Fail", 70)],
        "inspection_id long, restaurant_name string, license_number string, source_city string, address string,"
        " city string, state string, zip string, latitude double, longitude double, inspection_date date,"
        " inspection_type string, inspection_result string, inspection_score int")
    stg = insp.select("restaurant_name", F.lit(None).cast("string").alias("aka_name"), "license_number",
                      F.lit(None).cast("string").alias("facility_type"),
                      F.lit(None).cast("string").alias("risk_category"), "source_city").distinct()
    dim_r = S.scd2_merge(None, stg, KEYS, TRACKED, D1, TS, "j", nullable=["license_number"])
    loc = D.dim_location(insp)
    assert loc.count() == 1 and loc.first()["latitude"] == 1.5 and loc.first()["longitude"] == 2.5
    fact = ST.load_fact(insp, dim_r, loc, D.dim_inspection_type(insp), validate=True)
    assert fact.count() == 2
    viol = spark.createDataFrame([(1, "39", "desc a", "c1", 3, "C"), (2, "39", "desc b", "c2", 5, "C")],
                                 "inspection_id long, violation_code string, violation_description string, "
                                 "violation_comments string, violation_points int, source_city string")
    bridge = ST.load_bridge(viol, fact, D.dim_violation(viol))
    assert bridge.count() == 2
    hashed = ST.load_fact(insp, dim_r, lookup="hash")
    assert fact.exceptAll(hashed).count() == 0


def test_assert_unique_raises(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(ValueError):
        D.assert_unique(df, ["k"])


def test_copies_of_an_inspection_do_not_multiply_violations(spark):
    insp = spark.createDataFrame(
        [(7, "R", None, "C", "A", "X", "S", "00001", 1.0, 2.0, dt.date(2024, 1, 1), "T", "Pass", 90)] * 3,
        "inspection_id long, restaurant_name string, license_number string, source_city string, address string,"
        " city string, state string, zip string, latitude double, longitude double, inspection_date date,"
        " inspection_type string, inspection_result string, inspection_score int")
    stg = insp.select("restaurant_name", F.lit(None).cast("string").alias("aka_name"), "license_number",
                      F.lit(None).cast("string").alias("facility_type"),
                      F.lit(None).cast("string").alias("risk_category"), "source_city").distinct()
    dim_r = S.scd2_merge(None, stg, KEYS, TRACKED, D1, TS, "j", nullable=["license_number"])
    fact = ST.load_fact(insp, dim_r, lookup="hash")
    assert fact.count() == 3                                   # copies stay whole
    viol = spark.createDataFrame([(7, "1", "d", None, 1, "C"), (7, "2", "e", None, 2, "C")],
                                 "inspection_id long, violation_code string, violation_description string, "
                                 "violation_comments string, violation_points int, source_city string")
    assert ST.load_bridge(viol, fact, lookup="hash").count() == 2   # ... without fan-out


def test_bridge_looks_up_inspections_only_and_by_short_keys(spark):
    insp = spark.createDataFrame([("1", "A", None, "C", "x", "y", "s", "00001", "t", D1, "Pass", 90)],
                                 "inspection_id string, restaurant_name string, license_number string, source_city string, address string, city string, "
                                 "state string, zip string, inspection_type string, inspection_date date, inspection_result string, inspection_score int")
    fact = ST.load_fact(insp, merge(spark, None, BASE, D1), lookup="hash")
    viol = spark.createDataFrame([("1", "C", "3", "d", "note"), ("2", "C", "3", "d", "none"), (None, "C", "3", "d", "none")],
                                 "inspection_id string, source_city string, violation_code string, violation_description string, violation_comments string")
    bridge = ST.load_bridge(viol, fact, lookup="hash")
    plan = bridge._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1   # the semi join; none with the dimension
    assert {f.name: f.dataType.simpleString() for f in bridge.schema}["inspection_key"] == "string"
    (key, note), = [(r["inspection_key"], r["violation_comments"]) for r in bridge.collect()]
    assert key == fact.first()["inspection_key"] and note == "note"
