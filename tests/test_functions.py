"""Scalar edge rows (FIXTURES §2-§3)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import (clean_name, delimited_parts, durability_key, hash_key, is_zip5, latitude_from,
                                 longitude_from, nonblank_count, parse_date, result_from_score, safe_cast,
                                 safe_int, score_bin, score_from_result, slot_parts, trim_spaces, zip_first5,
                                 zip_pad)
from tidewater.functions.dates import date_parts
from tidewater.operators.columns import sanitize_columns, sanitize_name

from conftest import rows


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(fn(F.col("x")).alias("y")).collect()]


def test_sanitize_names():
    assert sanitize_name("License #") == "License"
    assert sanitize_name("Violation Description - 1") == "Violation_Description_1"
    assert sanitize_name(" A-b ") == "A_b"


def test_sanitize_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`A#` int, A int")
    with pytest.raises(ValueError):
        sanitize_columns(df)
    assert sanitize_columns(df, on_collision="suffix").columns == ["A", "A_1"]


def test_zip_pad(spark):
    out = one_col(spark, ["60601", "6061.0", "606", "60601-1234", None], zip_pad)
    assert out == ["60601", "06061", "606", "60601-1234", None]
    ok = one_col(spark, out, is_zip5)
    assert ok == [True, True, False, False, False]


def test_zip_first5(spark):
    assert one_col(spark, ["75228-3007", "752435219", "7522", None], zip_first5) == ["75228", "75243", None, None]


def test_safe_casts(spark):
    assert one_col(spark, [" RODENTS", "", "41.5"], lambda c: safe_cast(c, "double")) == [None, None, 41.5]
    assert one_col(spark, ["95.7", "95", "N/A"], safe_int) == [None, 95, None]


def test_parse_date(spark):
    out = one_col(spark, ["01/05/2020", "2020-01-02", "junk"], parse_date)
    assert out == [dt.date(2020, 1, 5), None, None]
    out = one_col(spark, ["01/05/2020", "2020-01-02"], lambda c: parse_date(c, iso_fallback=True))
    assert out == [dt.date(2020, 1, 5), dt.date(2020, 1, 2)]


def test_latlong(spark):
    df = spark.createDataFrame([("(32.77, -96.8)",), ("1313 MAIN ST\n(32.77, -96.8)",)], "x string")
    got = rows(df.select(latitude_from("x"), longitude_from("x")))
    assert got == [(32.77, -96.8), (32.77, -96.8)]


def test_score_from_result(spark):
    out = one_col(spark, ["Pass", "Pass w/ Conditions", "Fail", "No Entry", "PASS", "Out of Business"],
                  score_from_result)
    assert out == [90, 80, 70, 0, None, None]


def test_result_from_score(spark):
    out = one_col(spark, [90, 89, 80, 79, 69, None], result_from_score, "int")
    assert out == ["Pass", "Pass w/ Conditions", "Pass w/ Conditions", "Fail", "Fail", None]


def test_score_bin(spark):
    out = one_col(spark, [100, 89, 70, 0, -26, None], score_bin, "int")
    assert out == ["90-100 (Excellent)", "80-89 (Good)", "70-79 (Fair)", "0-69 (Poor)", "No Score", "No Score"]


def test_trim_keeps_tab_and_clean_name(spark):
    assert one_col(spark, ["\t a "], trim_spaces) == ["\t a"]
    assert one_col(spark, [' "A ""R"" US" '], clean_name) == ["A R US"]


def test_date_parts(spark):
    df = spark.createDataFrame([(dt.date(2020, 1, 5),)], "d date")
    r = df.select(*[c.alias(k) for k, c in date_parts("d").items()]).first().asDict()
    assert r == {"date_key": 20200105, "day": 5, "month": 1, "month_name": "January", "quarter": 1,
                 "year": 2020, "day_of_week": 1, "day_name": "Sunday"}


def test_durability_key(spark):
    df = spark.createDataFrame([(1, None, dt.date(2020, 1, 1)), (1, "NULL", dt.date(2020, 1, 1))],
                               "a int, b string, c date")
    keys = [r[0] for r in df.select(durability_key(["a", "b", "c"])).collect()]
    assert keys[0] == keys[1]   # documented collision of NULL and the text 'NULL'
    df2 = spark.createDataFrame([("1", None, "2020-01-01")], "a string, b string, c string")
    assert df2.select(durability_key(["a", "b", "c"])).first()[0] == \
        "af9a7db0a553d7d4123267b2347fc53b9fa9d0905813da0e7b382537a838670f"


def test_hash_key_keeps_tuples_apart(spark):
    df = spark.createDataFrame([(None, "x"), ("NULL", "x"), ("", "x")], "a string, b string")
    keys = [r[0] for r in df.select(hash_key(["a", "b"])).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)
    df = spark.createDataFrame([("a|=1:b", "c"), ("a", "b|=1:c")], "a string, b string")
    assert df.select(hash_key(["a", "b"])).distinct().count() == 2


def test_nonblank_count(spark):
    df = spark.createDataFrame([("a", "", None), (None, None, None)], "a string, b string, c string")
    assert [r[0] for r in df.select(nonblank_count(["a", "b", "c"])).collect()] == [1, 0]


VIOL = [
    ("1. DESC A - Comments: one line", "1", "DESC A", "one line"),
    ("2. DESC B - Comments: l1\nl2", "2", "", "l1"),
    ("3. NO COMMENT", "3", "NO COMMENT", ""),
    ("4. A - Comments: x - Comments: y", "4", "A", "x - Comments: y"),
    ("no code text", "", "", ""),
]


def test_delimited_parts_strict(spark):
    df = spark.createDataFrame([(v[0],) for v in VIOL], "raw string")
    parts = delimited_parts("raw", fallback=False)
    got = rows(df.select(*[c.alias(k) for k, c in parts.items()]))
    assert got == [v[1:] for v in VIOL]


def test_delimited_parts_fallback(spark):
    df = spark.createDataFrame([(VIOL[1][0],), (VIOL[4][0],)], "raw string")
    parts = delimited_parts("raw", fallback=True)
    got = rows(df.select(*[c.alias(k) for k, c in parts.items()]))
    assert got[0][:2] == ("2", "DESC B - Comments: l1\nl2")
    assert got[1][:2] == (None, "no code text")


def test_delimited_parts_dotall(spark):
    df = spark.createDataFrame([(VIOL[1][0],)], "raw string")
    parts = delimited_parts("raw", fallback=False, dotall=True)
    got = rows(df.select(*[c.alias(k) for k, c in parts.items()]))
    assert got == [("2", "DESC B", "l1\nl2")]


def test_slot_parts(spark):
    df = spark.createDataFrame([("*39 Food contact",), ("Temp 41 F at *12 Foo",), ("FOOD CODE",)], "raw string")
    strict = rows(df.select(*[c.alias(k) for k, c in slot_parts("raw", fallback=False).items()]))
    assert strict == [("39", "Food contact"), ("41", "F at *12 Foo"), ("", "")]
    loose = rows(df.select(*[c.alias(k) for k, c in slot_parts("raw", fallback=True).items()]))
    assert loose[2] == (None, "FOOD CODE")


def test_packed_text_gives_the_text_back(spark):
    from tidewater.functions import packed_text, unpacked_text
    texts = ["", "0", "00", "abc", "abcd", "ABCD", "aBcd", "1234567", "12345678", " ab", "zz", "\u00e9\u00e9", "0123456789abcdef0123456789abcdef", None]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", packed_text("t").alias("p")).select("t", "p", unpacked_text("p").alias("u")).collect()
    assert [r["u"] for r in got] == texts
    assert len({bytes(r["p"]) for r in got[:-1]}) == len(texts) - 1 and got[-1]["p"] is None
    assert len(got[-2]["p"]) == 17
