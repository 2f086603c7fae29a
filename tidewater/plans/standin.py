"""Driver tables mapped onto the two-source inspection model.

The driver ships TPC-H-style tables, not inspection files, so the pipeline runs on
stand-ins derived from them (every mapping below is a pure projection/aggregate, so
the work grows with the tables):

* source ``north`` (text results, no scores, no points): one inspection per order;
  business = customer (licence = custkey, facility = market segment), risk from the
  order priority, result from the order status, location from the customer's nation.
* source ``south`` (numeric scores, no licence): one inspection per (order, supplier)
  lineitem group; business = supplier, score = 2 x max quantity, date = last ship date.
* violations: one per lineitem row for both sources; code = brand number, description
  = part type; ``north`` carries comments, ``south`` carries points (part size).

``raw_north`` / ``raw_south`` are string-typed "bronze" versions with deterministic dirt
(quotes, padding, bad dates, ZIP+4, text in coordinates, negative scores) derived from
data values, used by the cleansing and rule queries.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.keys import hash_key
from tidewater.functions.scoring import result_from_score, score_from_result
from tidewater.operators.dedupe import dedupe, latest_per_key

NORTH = "north"
SOUTH = "south"

# fixed parameters of the two-batch SCD2 scenario on the stand-in data
SCD2_CUTOFF = dt.date(1998, 1, 1)          # batch 1 = inspections before this day
SCD2_AS_OF_1 = dt.date(1998, 1, 1)
SCD2_AS_OF_2 = dt.date(2001, 12, 1)
SCD2_RUN_TS_1 = dt.datetime(1998, 1, 1, 6, 0, 0)
SCD2_RUN_TS_2 = dt.datetime(2001, 12, 1, 6, 0, 0)
SCD2_JOB_1 = "load-1"
SCD2_JOB_2 = "load-2"
SNAPSHOT_RUN_TS = dt.datetime(2001, 12, 1, 6, 0, 0)   # plus one hour for each year's snapshot
SNAPSHOT_YEARS = range(1992, 1999)         # one snapshot of each year's inspections, as of the 1st of January after it
RESTAURANT_KEYS = ["restaurant_name", "source_city", "license_number"]
RESTAURANT_NULLABLE = ["license_number"]
TRACKED = ["facility_type", "risk_category", "aka_name"]
STAGING_COLS = ["restaurant_name", "aka_name", "license_number", "facility_type", "risk_category", "source_city"]


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d.rstrip('/')}/{name}.parquet")


def _nk(c: str) -> F.Column:
    return F.lpad(F.col(c).cast("string"), 2, "0")


def north_inspections(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    result = (F.when(F.col("o_orderstatus") == "F", F.lit("Pass"))
              .when(F.col("o_orderstatus") == "P", F.lit("Pass w/ Conditions"))
              .otherwise(F.lit("Fail")))
    nk = F.col("c_nationkey").cast("double")
    return j.select(
        F.col("o_orderkey").cast("string").alias("inspection_id"),
        F.col("c_name").alias("restaurant_name"),
        F.lit(None).cast("string").alias("aka_name"),
        F.col("c_custkey").cast("string").alias("license_number"),
        F.col("c_mktsegment").alias("facility_type"),
        F.concat(F.lit("Risk "), F.substring("o_orderpriority", 1, 1)).alias("risk_category"),
        F.concat(F.col("n_name"), F.lit(" AVE")).alias("address"),
        F.col("n_name").alias("city"),
        F.lit("N").alias("state"),
        F.concat(F.lit("606"), _nk("c_nationkey")).alias("zip"),
        (nk / 100 + 41).alias("latitude"),
        (F.lit(-87) - nk / 100).alias("longitude"),
        F.col("o_orderdate").cast("date").alias("inspection_date"),
        F.expr("substr(o_orderpriority, 3)").alias("inspection_type"),
        result.alias("inspection_result"),
        score_from_result(result).alias("inspection_score"),
        F.lit(NORTH).alias("source_city"))


def south_inspections(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    g = li.groupBy("l_orderkey", "l_suppkey").agg(
        F.max("l_quantity").alias("q"), F.max("l_shipdate").alias("ship"), F.max("l_linestatus").alias("ls"))
    j = g.join(s, g["l_suppkey"] == s["s_suppkey"]).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    score = (F.col("q").cast("int") * 2)
    nk = F.col("s_nationkey").cast("double")
    return j.select(
        hash_key(["l_orderkey", "l_suppkey"]).alias("inspection_id"),
        F.col("s_name").alias("restaurant_name"),
        F.lit(None).cast("string").alias("aka_name"),
        F.lit(None).cast("string").alias("license_number"),
        F.lit(None).cast("string").alias("facility_type"),
        F.lit(None).cast("string").alias("risk_category"),
        F.concat(F.col("n_name"), F.lit(" ST")).alias("address"),
        F.col("n_name").alias("city"),
        F.lit("S").alias("state"),
        F.concat(F.lit("752"), _nk("s_nationkey")).alias("zip"),
        (nk / 100 + 32).alias("latitude"),
        (F.lit(-96) - nk / 100).alias("longitude"),
        F.col("ship").cast("date").alias("inspection_date"),
        F.when(F.col("ls") == "F", F.lit("Routine")).otherwise(F.lit("Follow-up")).alias("inspection_type"),
        result_from_score(score).alias("inspection_result"),
        score.alias("inspection_score"),
        F.lit(SOUTH).alias("source_city"))


def silver_inspections(spark: SparkSession, d: str) -> DataFrame:
    return north_inspections(spark, d).unionByName(south_inspections(spark, d))


def silver_violations(spark: SparkSession, d: str) -> DataFrame:
    """Both sources' violations from ONE lineitem x part join: each joined row emits a
    north and a south entry via inline(array(...)); then a deterministic dedupe on
    (inspection_id, code, description). The numbers an id is made of stand for it until
    then: they are a fraction of its text in the shuffle and its sorts."""
    li = table(spark, d, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_returnflag", "l_linestatus")
    p = table(spark, d, "part").select("p_partkey", "p_brand", "p_type", "p_size")
    j = li.join(p, li["l_partkey"] == p["p_partkey"])
    code = F.expr("substr(p_brand, 7)")
    north = F.struct(F.col("l_orderkey"), F.lit(None).cast(li.schema["l_suppkey"].dataType).alias("l_suppkey"), code.alias("violation_code"),
                     F.col("p_type").alias("violation_description"),
                     F.concat("l_returnflag", "l_linestatus").alias("violation_comments"),
                     F.lit(None).cast("int").alias("violation_points"), F.lit(NORTH).alias("source_city"))
    south = F.struct(F.col("l_orderkey"), F.col("l_suppkey"), code.alias("violation_code"),
                     F.col("p_type").alias("violation_description"),
                     F.lit(None).cast("string").alias("violation_comments"),
                     F.col("p_size").cast("int").alias("violation_points"), F.lit(SOUTH).alias("source_city"))
    v = j.select(F.inline(F.array(north, south)))
    once = dedupe(v, ["l_orderkey", "l_suppkey", "violation_code", "violation_description", "source_city"])
    made = F.when(F.col("source_city") == SOUTH, hash_key(["l_orderkey", "l_suppkey"])).otherwise(F.col("l_orderkey").cast("string"))
    return once.select(made.alias("inspection_id"), *[c for c in once.columns if c not in ("l_orderkey", "l_suppkey")])


def staging_restaurants(insp: DataFrame) -> DataFrame:
    """Latest attributes per business (latest inspection date, then highest inspection id).

    A blank licence is no licence: rows with NULL and with '' are the same business, as they
    are to the dimension's business key, so staging has each key once.
    """
    named = insp.withColumn("license_number", F.when(F.col("license_number") != "", F.col("license_number")))
    latest = latest_per_key(named.select(*STAGING_COLS, "inspection_date", "inspection_id"),
                            RESTAURANT_KEYS, ["inspection_date", "inspection_id"])
    return latest.select(*STAGING_COLS)


def yearly_snapshots(insp: DataFrame) -> DataFrame:
    """A staging snapshot of each year: its businesses with their latest values; those without an inspection are missing."""
    year = F.year("inspection_date")
    named = insp.withColumn("license_number", F.when(F.col("license_number") != "", F.col("license_number"))).withColumn("y", year)
    latest = latest_per_key(named.select(*STAGING_COLS, "y", "inspection_date", "inspection_id"),
                            [*RESTAURANT_KEYS, "y"], ["inspection_date", "inspection_id"])
    return latest.where(F.col("y").between(SNAPSHOT_YEARS[0], SNAPSHOT_YEARS[-1])).select(
        *STAGING_COLS, F.make_date(F.col("y") + 1, F.lit(1), F.lit(1)).alias("as_of"),
        (F.lit(SNAPSHOT_RUN_TS) + F.make_interval(hours=F.col("y") - SNAPSHOT_YEARS[0])).cast("timestamp").alias("run_ts"),
        F.concat(F.lit("year-"), F.col("y")).alias("job_id"))


# ---- raw (bronze-like) string frames with deterministic dirt ---------------------------

def raw_north(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    c = table(spark, d, "customer")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    pri, st, seg = F.col("o_orderpriority"), F.col("o_orderstatus"), F.col("c_mktsegment")
    return j.select(
        F.col("o_orderkey").cast("string").alias("Inspection ID"),
        F.when((pri == "5-LOW") & (st == "P"), F.lit(""))
         .otherwise(F.concat(F.lit(' "'), F.col("c_name"), F.lit('" '))).alias("DBA Name"),
        F.lit(None).cast("string").alias("AKA Name"),
        F.col("c_custkey").cast("string").alias("License #"),
        F.concat(F.lit(" "), seg).alias("Facility Type"),
        F.concat(F.lit("Risk "), F.substring(pri, 1, 1)).alias("Risk"),
        F.concat(F.lit(" "), F.col("n_name"), F.lit(" AVE ")).alias("Address"),
        F.lower(F.col("n_name")).alias("City"),
        F.lit(" il").alias("State"),
        F.when(seg == "MACHINERY", F.concat(F.lit("606"), _nk("c_nationkey"), F.lit("-1234")))
         .otherwise(F.concat((F.col("c_nationkey") * 2500 + 6000).cast("string"), F.lit(".0"))).alias("Zip"),
        F.when((pri == "4-NOT SPECIFIED") & (st == "P"), F.lit("not a date"))
         .otherwise(F.date_format("o_orderdate", "MM/dd/yyyy")).alias("Inspection Date"),
        F.concat(F.lit(" "), F.expr("substr(o_orderpriority, 3)")).alias("Inspection Type"),
        F.when(st == "F", F.lit("Pass")).when(st == "P", F.lit("Pass w/ Conditions"))
         .otherwise(F.lit("Fail")).alias("Results"),
        F.when(pri == "3-MEDIUM", F.lit(""))
         .otherwise(F.concat(F.substring(pri, 1, 1), F.lit(". "), F.expr("substr(o_orderpriority, 3)"),
                             F.lit(" - Comments: "), seg, F.lit(" | 9. OTHER"))).alias("Violations"),
        F.when(seg == "HOUSEHOLD", F.lit(" RODENTS"))
         .otherwise(F.concat(F.lit("41."), _nk("c_nationkey"))).alias("Latitude"),
        F.concat(F.lit("-87."), _nk("c_nationkey")).alias("Longitude"))


def raw_south(spark: SparkSession, d: str) -> DataFrame:
    """One raw row per lineitem with four wide violation slots (description, points,
    detail, memo); slot 3 is blank for returned items, slot 4 only for open lines."""
    li = table(spark, d, "lineitem")
    s = table(spark, d, "supplier")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    j = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    q = F.col("l_quantity").cast("int")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return j.select(
        F.col("l_orderkey").cast("string").alias("Order Key"),
        F.col("l_linenumber").cast("string").alias("Line Number"),
        F.concat(F.lit(" "), F.col("s_name")).alias("Restaurant Name"),
        F.when(ls == "O", F.lit("Follow-up")).otherwise(F.lit("Routine")).alias("Inspection Type"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("Inspection Date"),
        F.when(F.col("l_discount") == 0, F.lit("N/A")).otherwise((q * 2 - 4).cast("string"))
         .alias("Inspection Score"),
        F.when(F.col("l_linenumber") < 7, F.concat(F.lit(" "), F.col("n_name"), F.lit(" ST "))).alias("Street Address"),
        F.concat(F.lit("75"), F.lpad(F.col("s_nationkey").cast("string"), 3, "0"),
                 F.when(ls == "O", F.lit("-3007")).otherwise(F.lit(""))).alias("Zip Code"),
        F.concat(F.col("n_name"), F.lit(" ST (32."), _nk("s_nationkey"), F.lit(", -96."),
                 _nk("s_nationkey"), F.lit(")")).alias("Lat Long Location"),
        F.concat(F.lit("*"), F.col("l_linenumber").cast("string"), F.lit(" Line check")).alias("Violation Description - 1"),
        F.col("l_linenumber").cast("string").alias("Violation Points - 1"),
        F.lit("detail").alias("Violation Detail - 1"),
        F.lit(None).cast("string").alias("Violation Memo - 1"),
        F.concat(F.lit("Flag "), rf).alias("Violation Description - 2"),
        F.lit("3").alias("Violation Points - 2"),
        F.lit(None).cast("string").alias("Violation Detail - 2"),
        F.concat(F.lit("memo "), ls).alias("Violation Memo - 2"),
        F.when(rf == "R", F.lit("")).otherwise(F.concat(F.lit("*"), (q + 10).cast("string"), F.lit(" Quantity")))
         .alias("Violation Description - 3"),
        F.when(rf == "R", F.lit("")).otherwise(F.lit("x2")).alias("Violation Points - 3"),
        F.lit(None).cast("string").alias("Violation Detail - 3"),
        F.lit(None).cast("string").alias("Violation Memo - 3"),
        F.when(ls == "O", F.concat(F.lit("*"), F.col("l_suppkey").cast("string"), F.lit(" Open line")))
         .alias("Violation Description - 4"),
        F.lit("1").alias("Violation Points - 4"),
        F.lit(None).cast("string").alias("Violation Detail - 4"),
        F.lit(None).cast("string").alias("Violation Memo - 4"))
