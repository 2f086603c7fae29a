"""Rules (FIXTURES §4), DQ split contract, profiling, reshape."""

from pyspark.sql import functions as F

from tidewater.operators.cleanse import cleanse
from tidewater.operators import profile as P
from tidewater.operators import quality as Q
from tidewater.operators.dedupe import dedupe, latest_per_key, latest_per_key_window
from tidewater.operators.reshape import split_explode, unpivot_slots
from tidewater.plans import silver as V

from conftest import rows


def test_south_rule_three_valued_logic(spark):
    data = [(None, 5), (None, 2), (95, 5), (95, 3), (80, 5), (-1, 2), (101, 2), (95, 0)]
    df = spark.createDataFrame(data, "score int, n int")
    rules = [Q.Rule("range", F.col("score").isNull() | F.col("score").between(0, 100)),
             Q.Rule("has", F.col("n") >= 1),
             Q.Rule("few", ~((F.col("score") >= 90) & (F.col("n") > 3)))]
    kept = rows(Q.apply_rules(df, rules))
    assert kept == [(None, 2), (95, 3), (80, 5)]
    audit = {r["rule_name"]: (r["dropped"], r["failed"]) for r in Q.rules_audit(df, rules).collect()}
    assert audit == {"range": (2, 2), "has": (1, 1), "few": (2, 2)}


def test_dq_split_contract(spark):
    df = spark.createDataFrame([(1, "a", "z"), (2, None, "z"), (3, "c", None), (4, None, None)],
                               "id int, name string, zip string")
    checks = [Q.Check("name_nn", "error", "name"), Q.Check("zip_nn", "warn", "zip")]
    valid, quarantine = Q.dq_split(df, checks)
    assert sorted(r[0] for r in valid.collect()) == [1, 3]          # warn-only row 3 is valid ...
    q = {r["id"]: (r["_errors"], r["_warnings"]) for r in quarantine.collect()}
    assert q == {2: (["name_nn"], []), 3: ([], ["zip_nn"]), 4: (["name_nn"], ["zip_nn"])}  # ... and quarantined
    s = Q.dq_summary(df, checks).first().asDict()
    assert (s["total"], s["valid"], s["quarantined"]) == (4, 2, 3)


def test_split_explode_drops_blank_fragments(spark):
    df = spark.createDataFrame([(1, "a| |b"), (2, None), (3, "|")], "id int, v string")
    out = rows(split_explode(df, "v", r"\|", with_position=True), "id", "fragment", "fragment_pos")
    assert out == [(1, "a", 1), (1, "b", 2)]


def test_unpivot_slots_skips_missing_and_blank(spark):
    df = spark.createDataFrame([(1, "*1 A", "3", "m1", "", "x", None)],
                               "id int, V_Description_1 string, V_Points_1 string, V_Memo_1 string, "
                               "V_Description_2 string, V_Points_2 string, V_Memo_2 string")
    out = unpivot_slots(df, "V", {"Description": "d", "Points": "p", "Detail": "det", "Memo": "m"},
                        "Description", ["id"], casts={"p": "int"})
    assert rows(out) == [(1, 1, "*1 A", 3, None, "m1")]


def test_dedupe_and_latest_are_deterministic(spark):
    df = spark.createDataFrame([(1, 10, "b"), (1, 10, "a"), (1, 5, "z"), (2, 1, None)], "k int, o int, v string")
    for parts in (1, 3):
        d = df.repartition(parts)
        assert sorted(rows(latest_per_key(d, ["k"], ["o"]))) == [(1, 10, "b"), (2, 1, None)]
        assert sorted(rows(dedupe(d, ["k"]))) == [(1, 5, "z"), (2, 1, None)]
        w = latest_per_key_window(d, ["k"], [F.desc("o")])
        assert sorted(rows(w)) == [(1, 10, "a"), (2, 1, None)]


def test_profile_nulls_and_distinct(spark):
    df = spark.createDataFrame([("a", 1), ("", None), (None, 1)], "s string, n int")
    nulls = {r["column_name"]: (r["null_count"], r["total_rows"]) for r in P.profile_nulls(df).collect()}
    assert nulls == {"s": (2, 3), "n": (1, 3)}
    dist = {r["column_name"]: r["distinct_count"] for r in P.profile_distinct(df).collect()}
    assert dist == {"s": 2, "n": 1}
    approx = {r["column_name"]: r["distinct_count"] for r in P.profile_distinct(df, approx=True).collect()}
    assert approx == {"s": 2, "n": 1}


def test_north_cleanse_and_rules(spark):
    cols = ["Inspection_ID", "DBA_Name", "AKA_Name", "License", "Facility_Type", "Risk", "Address", "City",
            "State", "Zip", "Inspection_Date", "Inspection_Type", "Results", "Violations", "Latitude", "Longitude"]
    base = ["1", ' "A" ', None, "7", " R ", "Risk 1", " 1 MAIN ", "springfield", "il", "6061.0", "01/05/2020",
            "Canvass", "Pass", "1. X - Comments: ok", "41.9", "-87.6"]
    urgent = base.copy()
    urgent[0], urgent[13] = "2", "1. X - Comments: URGENT fix"
    cond = base.copy()
    cond[0], cond[12], cond[13] = "3", "Pass w/ Conditions", "1. X - Comments: critical"
    df = spark.createDataFrame([base, urgent, cond], ", ".join(f"{c} string" for c in cols))
    ok = rows(spark.createDataFrame(
        Q.apply_rules(cleanse(df, V.NORTH), V.north_rules()).select("Inspection_ID", "DBA_Name", "City", "Zip",
                                                                   "Inspection_Score").collect()))
    assert ok == [("1", "A", "SPRINGFIELD", "06061", 90), ("3", "A", "SPRINGFIELD", "06061", 80)]


def test_overlay_and_overrides(spark):
    from tidewater.operators.columns import overlay, with_overrides
    df = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, s string, n int")
    got = rows(overlay(df, "k", [2], {"s": "X"}))
    assert got == [(1, "a", 5), (2, "X", 6)]
    clone = with_overrides(df.limit(1), {"k": "9", "n": 7})
    assert [f.dataType for f in clone.schema] == [f.dataType for f in df.schema]
    assert rows(clone) == [(9, "a", 7)]
