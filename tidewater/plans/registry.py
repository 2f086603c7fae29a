"""Registered queries: name -> (Spark builder, oracle SQL or None).

Each builder takes (spark, sf_dir) and returns a lazy DataFrame over the WHOLE driver
tables. Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType

from tidewater.config import SourceMapping
from tidewater.functions import (clean_name, delimited_parts, durability_key, latitude_from,
                                 longitude_from, parse_date, result_from_score, safe_cast, score_from_result,
                                 trim_spaces, upper_trim, zip_first5, zip_pad)
from tidewater.operators import checks as K
from tidewater.operators import cleanse as CL
from tidewater.operators import columns as C
from tidewater.operators import dims as D
from tidewater.operators import profile as P
from tidewater.operators import quality as Q
from tidewater.operators import reports as R
from tidewater.operators import scd2 as SCD
from tidewater.operators import sketches as K2
from tidewater.operators import star as ST
from tidewater.operators.asof import as_of_lookup
from tidewater.operators.reshape import split_explode
from tidewater.plans import oracle as O
from tidewater.plans import silver as V
from tidewater.plans import standin as S
from tidewater.session import shuffles_dropped, stored

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def query(name: str, sql: str | None):
    def deco(fn: Builder) -> Builder:
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


class Model:
    """Lazily built frames of the stand-in pipeline for one (session, data dir)."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    @cached_property
    def insp(self):
        # both batches, every dimension and the fact read it: computed once, from one scan of the sources
        return stored(S.silver_inspections(self.spark, self.d), "inspections")

    @cached_property
    def viol(self):
        return S.silver_violations(self.spark, self.d)

    @cached_property
    def stg1(self):
        return S.staging_restaurants(self.insp.filter(F.col("inspection_date") < F.lit(S.SCD2_CUTOFF)))

    @cached_property
    def stg2(self):
        return S.staging_restaurants(self.insp)

    @cached_property
    def dim1(self):
        return SCD.scd2_merge(None, self.stg1, S.RESTAURANT_KEYS, S.TRACKED, S.SCD2_AS_OF_1, S.SCD2_RUN_TS_1,
                              S.SCD2_JOB_1, nullable=S.RESTAURANT_NULLABLE, validate=False)  # staging is one row a key

    @cached_property
    def dim2(self):
        return stored(SCD.scd2_merge(self.dim1, self.stg2, S.RESTAURANT_KEYS, S.TRACKED, S.SCD2_AS_OF_2, S.SCD2_RUN_TS_2,
                                     S.SCD2_JOB_2, nullable=S.RESTAURANT_NULLABLE, validate=False), "dim-restaurant")

    @cached_property
    def dim_years(self):
        return stored(SCD.scd2_from_snapshots(S.yearly_snapshots(self.insp), S.RESTAURANT_KEYS, S.TRACKED,
                                              nullable=S.RESTAURANT_NULLABLE), "dim-years")

    @cached_property
    def loc(self):
        return D.dim_location(self.insp)

    @cached_property
    def typ(self):
        return D.dim_inspection_type(self.insp)

    @cached_property
    def dimv(self):
        return D.dim_violation(self.viol)

    @cached_property
    def dimdate(self):
        return D.dim_date([(self.insp, "inspection_date")])

    @cached_property
    def fact(self):
        # location/type keys are functions of the natural key: computed in place, no join
        return ST.load_fact(self.insp, self.dim2, lookup="hash")

    @cached_property
    def fact_joined(self):
        return ST.load_fact(self.insp, self.dim2, self.loc, self.typ, lookup="join")

    @cached_property
    def bridge(self):
        return ST.load_bridge(self.viol, self.fact, lookup="hash")

    @cached_property
    def bridge_joined(self):
        return ST.load_bridge(self.viol, self.fact, self.dimv, lookup="join")

    # raw / bronze-like
    @cached_property
    def raw_north(self):
        return C.sanitize_columns(S.raw_north(self.spark, self.d))

    @cached_property
    def raw_south(self):
        return C.sanitize_columns(S.raw_south(self.spark, self.d))

    @cached_property
    def north_clean(self):
        return CL.cleanse(self.raw_north, V.NORTH)

    @cached_property
    def south_clean(self):
        return V.south_clean(self.raw_south)

    @cached_property
    def north_ok(self):
        return Q.apply_rules(self.north_clean, V.north_rules())

    @cached_property
    def south_ok(self):
        return Q.apply_rules(self.south_clean, V.south_rules())


DIM_OUT = ["restaurant_name", "aka_name", "license_number", "facility_type", "risk_category", "source_city",
           "restaurant_key", "effective_start_date", "effective_end_date", "is_current", "etl_job_id"]


# =========================== scans, sinks-side reports ===================================

@query("scan_select", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'")
def scan_select(spark, d):
    # scan -> filter -> project: pruned columns and the pushed filter, nothing else
    return spark.read.parquet(f"{d.rstrip('/')}/orders.parquet").filter(F.col("o_orderstatus") == "F") \
        .select("o_orderkey", "o_custkey", "o_orderdate")


@query("filter_current", O.ALL + f"SELECT {', '.join(DIM_OUT)} FROM dim2 WHERE is_current")
def filter_current(spark, d):
    return Model(spark, d).dim2.filter(F.col("is_current")).select(*DIM_OUT)


_COUNTS = [("fact_inspection", "fact"), ("bridge_inspection_violation", "bridge"), ("dim_restaurant", "dim2"),
           ("dim_location", "loc"), ("dim_inspection_type", "typ"), ("dim_violation", "dimv"),
           ("dim_date", "dimdate")]


@query("table_counts", O.ALL + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {t}" for n, t in _COUNTS))
def table_counts(spark, d):
    m = Model(spark, d)
    m.viol = stored(m.viol, "violations")   # the fact is counted as it is made: of its rows nothing else is needed
    out = None
    for n, attr in _COUNTS:
        one = getattr(m, attr).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(n).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def _fresh(spark, name):
    import uuid

    from tidewater.session import scratch_path
    return scratch_path(spark, f"roundtrip/{name}-{uuid.uuid4().hex[:12]}")


_RT_TS = __import__("datetime").datetime(2001, 12, 1, 6, 0, 0)
_RT_RUN = "20011201_060000"

# =========================== projections and cleansing ===================================

_SAN = ", ".join(f'"{r}" AS {s}' for r, s in zip(O.NORTH_RAW_NAMES, O.NORTH_RAW_SANITIZED))


@query("sanitize_columns", "WITH " + O.RAW_NORTH + f" SELECT {_SAN} FROM raw_north")
def sanitize_columns(spark, d):
    return Model(spark, d).raw_north


# CSV cannot tell NULL from '': an empty field reads back as NULL
_SAN_CSV = ", ".join(f"nullif(\"{r}\", '') AS {s}" for r, s in zip(O.NORTH_RAW_NAMES, O.NORTH_RAW_SANITIZED))


@query("csv_roundtrip", "WITH " + O.RAW_NORTH + f" SELECT {_SAN_CSV} FROM raw_north")
def csv_roundtrip(spark, d):
    """Multi-line CSV sink + explicit-schema reader: write the raw frame, read it back
    (values byte-exact, including surrounding spaces and embedded quotes)."""
    from tidewater.sinks import write_csv_extract
    from tidewater.sources.csv import read_csv, string_schema
    raw = Model(spark, d).raw_north
    path = write_csv_extract(raw, _fresh(spark, "csv"), single_file=False)
    return read_csv(spark, path, schema=string_schema(raw.columns), multiline=True)


@query("csv_ingest", "WITH " + O.RAW_NORTH +
       f" SELECT {_SAN_CSV}, 'north' AS data_source_name, 'csv-job' AS etl_job_id FROM raw_north")
def csv_ingest(spark, d):
    """CSV files -> explicit string schema -> sanitised names -> lineage -> bronze table, read back."""
    import datetime as dt

    from tidewater.config import RunConfig
    from tidewater.plans.pipeline import ingest
    from tidewater.sinks import write_csv_extract
    from tidewater.sources.csv import string_schema
    raw = S.raw_north(spark, d)
    path = write_csv_extract(raw, _fresh(spark, "csv"))
    cfg = RunConfig(_fresh(spark, "bronze"), job_id="csv-job", as_of=dt.date(2001, 12, 1), run_ts=_RT_TS)
    return spark.read.parquet(ingest(spark, path, string_schema(raw.columns), "north", cfg)).drop("ingest_timestamp")


_DAMAGED = """
WITH t AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_suppkey % 10 AS k FROM supplier)"""
_LINE = '''CASE k WHEN 1 THEN s_suppkey || ',' || s_name || ',' || s_nationkey
  WHEN 2 THEN s_suppkey || ',' || s_name || ',' || s_nationkey || ',x,surplus' WHEN 3 THEN s_suppkey || ',"' || s_name || ',' || s_nationkey || ',open'
  WHEN 4 THEN s_suppkey || ',"' || s_name || ', ""quoted""",' || s_nationkey || ',' ELSE s_suppkey || ',' || s_name || ',' || s_nationkey || ',y' END'''


def _damaged_csv(spark, d):
    """Suppliers as CSV lines, of which some lack a cell, have one too many or an open quote; read with its bad records kept apart."""
    from tidewater.sources.csv import read_csv_checked, string_schema
    t = S.table(spark, d, "supplier").selectExpr("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_suppkey % 10 AS k")
    path = _fresh(spark, "damaged")
    t.selectExpr(_LINE + " AS value").write.text(path)
    return read_csv_checked(spark, path, string_schema(["id", "name", "nation", "note"]), multiline=False, header=False)


@query("csv_good_rows", _DAMAGED + """ SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN k = 4 THEN s_name || ', "quoted"' ELSE s_name END AS name,
  CAST(s_nationkey AS VARCHAR) AS nation, CASE WHEN k = 4 THEN NULL ELSE 'y' END AS note FROM t WHERE k NOT IN (1, 2, 3)""")
def csv_good_rows(spark, d):
    return _damaged_csv(spark, d).rows


@query("csv_quarantine", _DAMAGED + f" SELECT {_LINE} AS record FROM t WHERE k IN (1, 2, 3)")
def csv_quarantine(spark, d):
    """Records with missing or surplus cells or an open quote, as they stand in the files."""
    return _damaged_csv(spark, d).bad.select("record")


@query("csv_counts", _DAMAGED + " SELECT count(*) AS seen, count_if(k NOT IN (1, 2, 3)) AS kept, count_if(k IN (1, 2, 3)) AS quarantined FROM t")
def csv_counts(spark, d):
    """Rows seen, kept and quarantined, summed over the files."""
    return _damaged_csv(spark, d).counts.agg(*[F.sum(c).alias(c) for c in ("seen", "kept", "quarantined")])


@query("csv_single_line", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def csv_single_line(spark, d):
    """The single-line reader over many files; types by cast."""
    from tidewater.sinks import write_csv_extract
    from tidewater.sources.csv import read_csv, string_schema
    cust = S.table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path = write_csv_extract(cust, _fresh(spark, "csv"))
    back = read_csv(spark, path, schema=string_schema(cust.columns), multiline=False)
    return back.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query("csv_single_file", """SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS orders, 1 AS files FROM orders GROUP BY o_orderpriority""")
def csv_single_file(spark, d):
    """A report as one CSV file."""
    from tidewater.sinks import write_csv_extract
    from tidewater.sources.csv import read_csv
    report = S.table(spark, d, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    back = read_csv(spark, write_csv_extract(report, _fresh(spark, "csv"), single_file=True))
    files = back.select(F.input_file_name().alias("f")).distinct().agg(F.count("f").cast("int")).scalar()
    return back.withColumn("files", files)


@query("table_refresh", "SELECT p_partkey, p_brand FROM part WHERE p_size <= 25")
def table_refresh(spark, d):
    """Full refresh of a partitioned table: a second, smaller load leaves no row of the first."""
    from tidewater.sinks import write_table
    part = S.table(spark, d, "part").select("p_partkey", "p_brand", "p_size")
    path = _fresh(spark, "refresh")
    write_table(part, path, partition_by=["p_size"])
    return spark.read.parquet(write_table(part.filter("p_size <= 25"), path, partition_by=["p_size"])).select("p_partkey", "p_brand")


@query("version_roundtrip", "SELECT s_suppkey, s_name, s_suppkey % 2 = 0 AS is_current FROM supplier WHERE s_suppkey % 2 = 0")
def version_roundtrip(spark, d):
    """Versioned table: two commits, the current rows of the second."""
    from tidewater.sinks import write_version
    from tidewater.sources.tables import read_current
    supp = S.table(spark, d, "supplier").select("s_suppkey", "s_name", (F.col("s_suppkey") % 2 == 0).alias("is_current"))
    base = _fresh(spark, "versions")
    write_version(spark, supp.limit(1), base)
    write_version(spark, supp, base)
    return read_current(spark, base, current_only=True)


@query("snapshot_roundtrip", """
SELECT c_name AS business_name, CAST(c_custkey AS VARCHAR) AS license_number, c_mktsegment AS segment,
       c_acctbal AS balance, c_nationkey AS nation_key, 'customer' AS source, '""" + _RT_RUN + """' AS run_id
FROM customer""")
def snapshot_roundtrip(spark, d):
    """Dated snapshot sink: base/table/yyyy/MM/dd/run_id=X, read back from the day folder."""
    from tidewater.sinks import snapshot_path, write_snapshot
    cust = SourceMapping("customer", {"business_name": "c_name", "license_number": "c_custkey",
                                      "segment": "c_mktsegment", "balance": "c_acctbal", "nation_key": "c_nationkey"},
                         {"source": "customer"})
    df = C.conform(S.table(spark, d, "customer"), cust, _CONFORM_TARGET)
    base = _fresh(spark, "snap")
    write_snapshot(df, base, "customers", _RT_TS, _RT_RUN)
    day = snapshot_path(base, "customers", _RT_TS, _RT_RUN).rsplit("/", 1)[0]
    return spark.read.option("basePath", day).parquet(day).withColumn("run_id", F.col("run_id").cast("string"))


@query("bronze_ingest", "WITH " + O.RAW_NORTH +
       f" SELECT {_SAN}, 'north' AS data_source_name, 'bronze-job' AS etl_job_id FROM raw_north")
def bronze_ingest(spark, d):
    df = C.add_bronze_lineage(Model(spark, d).raw_north, "north", job_id="bronze-job")
    return df.drop("ingest_timestamp")


@query("lineage_key", O.RAW + """SELECT Inspection_ID, sha256(concat_ws('||', coalesce(CAST(Inspection_ID AS VARCHAR),
  'NULL'), coalesce(CAST(DBA_Name AS VARCHAR), 'NULL'), coalesce(CAST(Inspection_Date AS VARCHAR), 'NULL')))
  AS durability_key FROM north_clean""")
def lineage_key(spark, d):
    m = Model(spark, d)
    return m.north_clean.select("Inspection_ID",
                                durability_key(["Inspection_ID", "DBA_Name", "Inspection_Date"]).alias("durability_key"))


_CONFORM_TARGET = [("business_name", StringType()), ("license_number", StringType()), ("segment", StringType()),
                   ("balance", DoubleType()), ("nation_key", IntegerType()), ("source", StringType())]


@query("conform_union", """
SELECT c_name AS business_name, CAST(c_custkey AS VARCHAR) AS license_number, c_mktsegment AS segment,
       c_acctbal AS balance, c_nationkey AS nation_key, 'customer' AS source FROM customer
UNION ALL
SELECT s_name, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), s_acctbal, s_nationkey, 'supplier' FROM supplier""")
def conform_union(spark, d):
    cust = SourceMapping("customer", {"business_name": "c_name", "license_number": "c_custkey",
                                      "segment": "c_mktsegment", "balance": "c_acctbal", "nation_key": "c_nationkey"},
                         {"source": "customer"})
    supp = SourceMapping("supplier", {"business_name": "s_name", "license_number": None, "segment": None,
                                      "balance": "s_acctbal", "nation_key": "s_nationkey"}, {"source": "supplier"})
    return C.conform_union([(S.table(spark, d, "customer"), cust), (S.table(spark, d, "supplier"), supp)],
                           _CONFORM_TARGET)


@query("cleanse_strings", "WITH " + O.RAW_NORTH + """ SELECT "Inspection ID" AS Inspection_ID,
  trim(replace("DBA Name", '"', '')) AS DBA_Name, trim("Address") AS Address, trim(upper("City")) AS City,
  trim(upper("State")) AS State, trim("Facility Type") AS Facility_Type, trim("Inspection Type") AS Inspection_Type
  FROM raw_north""")
def cleanse_strings(spark, d):
    r = Model(spark, d).raw_north
    return r.select("Inspection_ID", clean_name("DBA_Name").alias("DBA_Name"), trim_spaces("Address").alias("Address"),
                    upper_trim("City").alias("City"), upper_trim("State").alias("State"),
                    trim_spaces("Facility_Type").alias("Facility_Type"),
                    trim_spaces("Inspection_Type").alias("Inspection_Type"))


@query("zip_pad", "WITH " + O.RAW_NORTH + r""" SELECT "Inspection ID" AS Inspection_ID, "Zip" AS zip_raw,
  CASE WHEN length(regexp_replace("Zip", '\.0$', '')) = 4 THEN '0' || regexp_replace("Zip", '\.0$', '')
       ELSE regexp_replace("Zip", '\.0$', '') END AS zip FROM raw_north""")
def zip_pad_q(spark, d):
    r = Model(spark, d).raw_north
    return r.select("Inspection_ID", F.col("Zip").alias("zip_raw"), zip_pad("Zip").alias("zip"))


@query("zip_first5", "WITH " + O.RAW_SOUTH + r""" SELECT "Order Key" AS order_key, "Zip Code" AS zip_raw,
  nullif(regexp_extract(regexp_replace("Zip Code", '\.0$', ''), '^(\d{5})', 1), '') AS zip FROM raw_south""")
def zip_first5_q(spark, d):
    r = Model(spark, d).raw_south
    return r.select(F.col("Order_Key").alias("order_key"), F.col("Zip_Code").alias("zip_raw"),
                    zip_first5("Zip_Code").alias("zip"))


@query("latlong_parse", "WITH " + O.RAW_SOUTH + r""" SELECT "Order Key" AS order_key,
  try_cast(regexp_extract("Lat Long Location", '\(([^,]+),', 1) AS DOUBLE) AS latitude,
  try_cast(regexp_extract("Lat Long Location", ',\s*([^)]+)\)', 1) AS DOUBLE) AS longitude FROM raw_south""")
def latlong_parse(spark, d):
    r = Model(spark, d).raw_south
    return r.select(F.col("Order_Key").alias("order_key"), latitude_from("Lat_Long_Location").alias("latitude"),
                    longitude_from("Lat_Long_Location").alias("longitude"))


@query("safe_cast", "WITH " + O.RAW_NORTH + """ SELECT "Inspection ID" AS Inspection_ID,
  try_cast("Latitude" AS DOUBLE) AS latitude, try_cast("Longitude" AS DOUBLE) AS longitude,
  CASE WHEN regexp_matches("Zip", '^\\s*[+-]?[0-9]+\\s*$') THEN try_cast("Zip" AS INTEGER) END AS zip_int
  FROM raw_north""")
def safe_cast_q(spark, d):
    r = Model(spark, d).raw_north
    return r.select("Inspection_ID", safe_cast("Latitude", "double").alias("latitude"),
                    safe_cast("Longitude", "double").alias("longitude"), safe_cast("Zip", "int").alias("zip_int"))


@query("date_parse", "WITH " + O.RAW_NORTH + """ SELECT "Inspection ID" AS Inspection_ID,
  CAST(try_strptime("Inspection Date", '%m/%d/%Y') AS DATE) AS inspection_date FROM raw_north""")
def date_parse(spark, d):
    r = Model(spark, d).raw_north
    return r.select("Inspection_ID", parse_date("Inspection_Date").alias("inspection_date"))


@query("score_from_result", O.RAW + "SELECT Inspection_ID, Results, Inspection_Score FROM north_clean")
def score_from_result_q(spark, d):
    c = Model(spark, d).north_clean
    return c.select("Inspection_ID", "Results", score_from_result("Results").alias("Inspection_Score"))


@query("result_from_score", O.RAW + "SELECT Inspection_ID, Inspection_Score, Results FROM south_clean")
def result_from_score_q(spark, d):
    c = Model(spark, d).south_clean
    return c.select("Inspection_ID", "Inspection_Score", result_from_score("Inspection_Score").alias("Results"))


@query("score_bins", O.RAW + """SELECT CASE WHEN Inspection_Score >= 90 THEN '90-100 (Excellent)'
  WHEN Inspection_Score >= 80 THEN '80-89 (Good)' WHEN Inspection_Score >= 70 THEN '70-79 (Fair)'
  WHEN Inspection_Score >= 0 THEN '0-69 (Poor)' ELSE 'No Score' END AS score_bin, count(*) AS count
  FROM south_clean GROUP BY 1""")
def score_bins(spark, d):
    return P.binned_distribution(Model(spark, d).south_clean, "Inspection_Score")


# =========================== rules, audit, DQ split =======================================

_NORTH_OUT = ["Inspection_ID", "DBA_Name", "License", "Inspection_Date", "Inspection_Type", "Zip", "Results",
              "Inspection_Score", "Latitude", "Longitude", "source_city"]
_SOUTH_OUT = ["Inspection_ID", "Restaurant_Name", "Inspection_Date", "Inspection_Type", "Zip_Code",
              "Inspection_Score", "Results", "Latitude", "Longitude", "violation_count", "source_city"]


@query("silver_north", O.RAW + f"SELECT {', '.join(_NORTH_OUT)} FROM north_ok")
def silver_north(spark, d):
    return Model(spark, d).north_ok.select(*_NORTH_OUT)


@query("silver_south", O.RAW + f"SELECT {', '.join(_SOUTH_OUT)} FROM south_ok")
def silver_south(spark, d):
    return Model(spark, d).south_ok.select(*_SOUTH_OUT)


@query("rules_audit_north", O.RAW[:-1] + O.audit_sql("north_clean", O.NORTH_RULES))
def rules_audit_north(spark, d):
    return Q.rules_audit(Model(spark, d).north_clean, V.north_rules())


@query("rules_audit_south", O.RAW[:-1] + O.audit_sql("south_clean", O.SOUTH_RULES))
def rules_audit_south(spark, d):
    return Q.rules_audit(Model(spark, d).south_clean, V.south_rules())


@query("rule_null_logic", O.RAW + """SELECT Inspection_Score IS NULL AS score_is_null, violation_count,
  count(*) AS rows_in, count_if(coalesce(NOT (Inspection_Score >= 90 AND violation_count > 3), FALSE)) AS rows_kept
  FROM south_clean GROUP BY 1, 2""")
def rule_null_logic(spark, d):
    c = Model(spark, d).south_clean
    keep = V.south_rules()[-1].keep
    return c.groupBy(F.col("Inspection_Score").isNull().alias("score_is_null"), "violation_count").agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(F.coalesce(keep, F.lit(False))).alias("rows_kept"))


def _dq_case(checks):
    parts = [f"CASE WHEN {column} IS NULL THEN '{name}' END" for name, column in checks]
    return f"array_to_string(list_filter([{', '.join(parts)}], lambda x: x IS NOT NULL), ',')"


def _any_null(checks):
    return " OR ".join(f"{column} IS NULL" for _, column in checks)


@query("dq_valid", O.RAW + "SELECT Inspection_ID, DBA_Name, Inspection_Date, Results FROM north_clean "
       f"WHERE NOT ({_any_null(O.NORTH_ERRORS)})")
def dq_valid(spark, d):
    valid, _ = Q.dq_split(Model(spark, d).north_clean, V.north_checks())
    return valid.select("Inspection_ID", "DBA_Name", "Inspection_Date", "Results")


@query("dq_quarantine", O.RAW + f"""SELECT Restaurant_Name, Inspection_Date, Inspection_Score,
  {_dq_case(O.SOUTH_ERRORS)} AS errors, {_dq_case(O.SOUTH_WARNINGS)} AS warnings FROM south_clean
  WHERE {_any_null(O.SOUTH_ERRORS + O.SOUTH_WARNINGS)}""")
def dq_quarantine(spark, d):
    _, quarantine = Q.dq_split(Model(spark, d).south_clean, V.south_checks())
    return quarantine.select("Restaurant_Name", "Inspection_Date", "Inspection_Score",
                             F.array_join("_errors", ",").alias("errors"),
                             F.array_join("_warnings", ",").alias("warnings"))


@query("dq_summary", O.RAW + f"""SELECT count(*) AS total, count_if(NOT ({_any_null(O.NORTH_ERRORS)})) AS valid,
  count_if({_any_null(O.NORTH_ERRORS + O.NORTH_WARNINGS)}) AS quarantined, """
       + ", ".join(f"count_if({c} IS NULL) AS failed_{n}" for n, c in O.NORTH_ERRORS + O.NORTH_WARNINGS) + " FROM north_clean")
def dq_summary(spark, d):
    return Q.dq_summary(Model(spark, d).north_clean, V.north_checks())


_SPLIT_CHECKS = [   # as a user's metadata gives them
    {"name": "id_not_null", "criticality": "error", "check": {"function": "is_not_null", "arguments": {"column": "Inspection_ID"}}},
    {"name": "name_filled", "criticality": "error", "check": {"function": "is_not_null_and_not_empty", "arguments": {"column": "DBA_Name"}}},
    {"name": "date_not_null", "criticality": "error", "check": {"function": "is_not_null", "arguments": {"column": "Inspection_Date"}}},
    {"name": "result_known", "criticality": "error", "check": {"function": "is_in_list", "arguments": {"column": "Results", "allowed": ["Pass", "Fail"]}}, "filter": "Facility_Type <> 'BUILDING'"},
    {"name": "zip_form", "criticality": "warn", "check": {"function": "regex_match", "arguments": {"column": "Zip", "regex": "^[0-9]{5}$"}}},
    {"name": "north_enough", "criticality": "warn", "check": {"function": "is_not_less_than", "arguments": {"column": "Latitude", "limit": 41.05}}}]
_SPLIT_SQL = O.RAW + """SELECT *, list_filter([CASE WHEN Inspection_ID IS NULL THEN 'id_not_null' END,
    CASE WHEN DBA_Name IS NULL OR DBA_Name = '' THEN 'name_filled' END, CASE WHEN Inspection_Date IS NULL THEN 'date_not_null' END,
    CASE WHEN Facility_Type <> 'BUILDING' AND Results NOT IN ('Pass', 'Fail') THEN 'result_known' END], lambda x: x IS NOT NULL) AS errs,
  list_filter([CASE WHEN NOT regexp_matches(Zip, '^[0-9]{5}$') THEN 'zip_form' END,
    CASE WHEN Latitude < 41.05 THEN 'north_enough' END], lambda x: x IS NOT NULL) AS warns FROM north_clean"""


@query("dq_metadata_valid", f"SELECT Inspection_ID, DBA_Name, Results, Zip, Latitude FROM ({_SPLIT_SQL}) WHERE len(errs) = 0")
def dq_metadata_valid(spark, d):
    valid, _ = K.split_by_metadata(Model(spark, d).north_clean, _SPLIT_CHECKS)
    return valid.select("Inspection_ID", "DBA_Name", "Results", "Zip", "Latitude")


@query("dq_metadata_quarantine", f"""SELECT Inspection_ID, array_to_string(errs, ',') AS errors, array_to_string(warns, ',') AS warnings
  FROM ({_SPLIT_SQL}) WHERE len(errs) > 0 OR len(warns) > 0""")
def dq_metadata_quarantine(spark, d):
    _, quarantine = K.split_by_metadata(Model(spark, d).north_clean, _SPLIT_CHECKS)
    return quarantine.select("Inspection_ID", F.array_join("_errors", ",").alias("errors"), F.array_join("_warnings", ",").alias("warnings"))


@query("dq_unique", """
WITH n AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_suppkey) AS pair, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS line,
                  count(*) FILTER (WHERE l_returnflag = 'R') OVER (PARTITION BY l_shipdate, l_partkey % 100) AS day,
                  sum(l_quantity) OVER (PARTITION BY l_orderkey) AS total FROM lineitem)
SELECT l_orderkey, l_linenumber, array_to_string(list_filter([CASE WHEN pair > 1 THEN 'pair_once' END, CASE WHEN line > 1 THEN 'line_once' END],
         lambda x: x IS NOT NULL), ',') AS errors,
       array_to_string(list_filter([CASE WHEN day > 1 AND l_returnflag = 'R' THEN 'return_once' END, CASE WHEN total > 250 THEN 'order_size' END],
         lambda x: x IS NOT NULL), ',') AS warnings
FROM n WHERE pair > 1 OR line > 1 OR (day > 1 AND l_returnflag = 'R') OR total > 250""")
def dq_unique(spark, d):
    """Unique keys of three grains and a bound on each order's quantity, over all line items."""
    items = S.table(spark, d, "lineitem").withColumn("part_group", F.col("l_partkey") % 100)
    _, bad = K.split_by_metadata(items, [
        {"name": "pair_once", "criticality": "error", "check": {"function": "is_unique", "arguments": {"columns": ["l_orderkey", "l_suppkey"]}}},
        {"name": "line_once", "criticality": "error", "check": {"function": "is_unique", "arguments": {"columns": ["l_orderkey", "l_linenumber"]}}},
        {"name": "return_once", "criticality": "warn", "filter": "l_returnflag = 'R'",
         "check": {"function": "is_unique", "arguments": {"columns": ["l_shipdate", "part_group"]}}},
        {"name": "order_size", "criticality": "warn", "check": {"function": "is_aggr_not_greater_than", "arguments": {
            "column": "l_quantity", "limit": 250, "aggr_type": "sum", "group_by": ["l_orderkey"]}}}])
    return bad.select("l_orderkey", "l_linenumber", F.array_join("_errors", ",").alias("errors"), F.array_join("_warnings", ",").alias("warnings"))


@query("dq_foreign_key", """
WITH served AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING'),
n AS (SELECT *, count(*) OVER (PARTITION BY o_custkey) AS orders, count(*) OVER () AS total FROM orders)
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_custkey NOT IN (SELECT c_custkey FROM served) THEN 'customer_known' END,
         CASE WHEN total < 1000000000 THEN 'enough_rows' END], lambda x: x IS NOT NULL), ',') AS errors,
       array_to_string(list_filter([CASE WHEN orders < 10 THEN 'busy' END], lambda x: x IS NOT NULL), ',') AS warnings
FROM n""")
def dq_foreign_key(spark, d):
    """Orders against the customers of four segments, on one grain with a bound on a customer's orders, and one on all rows."""
    served = S.table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'")
    marked = K.annotate(S.table(spark, d, "orders"), [
        {"name": "customer_known", "criticality": "error", "check": {"function": "foreign_key", "arguments": {
            "columns": ["o_custkey"], "ref_columns": ["c_custkey"], "ref_df_name": "served"}}},
        {"name": "enough_rows", "criticality": "error", "check": {"function": "is_aggr_not_less_than", "arguments": {"column": "*", "limit": 10 ** 9}}},
        {"name": "busy", "criticality": "warn", "check": {"function": "is_aggr_not_less_than", "arguments": {
            "column": "o_orderkey", "limit": 10, "group_by": ["o_custkey"]}}}], {"served": served})
    return marked.select("o_orderkey", F.array_join("_errors", ",").alias("errors"), F.array_join("_warnings", ",").alias("warnings"))


@query("violation_flags", O.RAW + """SELECT
  (SELECT count_if(NOT (Violations IS NOT NULL AND Violations <> '')) FROM north_clean) AS north_no_violation,
  (SELECT CAST(count_if(NOT (Violations IS NOT NULL AND Violations <> '')) AS DOUBLE) * 100 / count(*)
     FROM north_clean) AS north_no_violation_pct,
  (SELECT count_if(Inspection_Score >= 90 AND violation_count > 3) FROM south_clean) AS south_high_score_many""")
def violation_flags(spark, d):
    m = Model(spark, d)
    nb = ~(F.col("Violations").isNotNull() & (F.col("Violations") != ""))
    north = m.north_clean.agg(F.count_if(nb).alias("north_no_violation"),
                              (F.count_if(nb).cast("double") * 100 / F.count(F.lit(1))).alias("north_no_violation_pct"))
    south = m.south_clean.agg(F.count_if((F.col("Inspection_Score") >= 90) & (F.col("violation_count") > 3))
                              .alias("south_high_score_many"))
    return north.select("*", south.scalar().alias("south_high_score_many"))


# =========================== profiling ====================================================

_PN = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL OR {c} = '') AS null_count, "
    f"CAST(count_if({c} IS NULL OR {c} = '') AS DOUBLE) * 100 / count(*) AS null_pct, count(*) AS total_rows FROM rn"
    for c in O.NORTH_RAW_SANITIZED)


@query("profile_nulls", "WITH " + O.RAW_NORTH + f", rn AS (SELECT {_SAN} FROM raw_north) {_PN}")
def profile_nulls(spark, d):
    return P.profile_nulls(Model(spark, d).raw_north)


_PD = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_count FROM rn"
                         for c in O.NORTH_RAW_SANITIZED)


@query("profile_distinct", "WITH " + O.RAW_NORTH + f", rn AS (SELECT {_SAN} FROM raw_north) {_PD}")
def profile_distinct(spark, d):
    return P.profile_distinct(Model(spark, d).raw_north)


_PL = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count_if({c} IS NULL OR {c} = '') AS null_count, "
    f"CAST(count_if({c} IS NULL OR {c} = '') AS DOUBLE) * 100 / count(*) AS null_pct, count(*) AS total_rows, "
    f"count(DISTINCT {c}) AS distinct_count FROM rn" for c in O.NORTH_RAW_SANITIZED)


@query("profile", "WITH " + O.RAW_NORTH + f", rn AS (SELECT {_SAN} FROM raw_north) {_PL}")
def profile_long(spark, d):
    return P.profile(Model(spark, d).raw_north)


_PR = ["Results", "Zip_Code", "Inspection_Score", "Violation_Memo_1"]


def _pr_sql() -> str:
    blank = lambda c: f"{c} IS NULL OR CAST({c} AS VARCHAR) = ''"
    out = []
    for c in _PR:
        for m, v in (("total_rows", "count(*)"), ("null_count", f"count_if({blank(c)})"),
                     ("null_pct", f"round(count_if({blank(c)}) * 100.0 / count(*), 2)"), ("distinct_count", f"count(DISTINCT {c})")):
            out.append(f"SELECT '{c}' AS column_name, '{m}' AS metric, CAST(NULL AS VARCHAR) AS label, CAST({v} AS DOUBLE) AS value FROM south_clean")
    out.append("""SELECT 'Zip_Code', 'frequency', Zip_Code, CAST(n AS DOUBLE) FROM (SELECT Zip_Code, count(*) AS n FROM south_clean
      GROUP BY Zip_Code ORDER BY n DESC, Zip_Code ASC NULLS FIRST LIMIT 5)""")
    for m, v in (("count", "count(Inspection_Score)"), ("mean", "round(avg(Inspection_Score), 6)"), ("stddev", "round(stddev_samp(Inspection_Score), 6)"),
                 ("min", "min(Inspection_Score)"), ("max", "max(Inspection_Score)"),
                 *((f"{q}%", f"quantile_disc(Inspection_Score, 0.{q})") for q in (25, 50, 75))):
        out.append(f"SELECT 'Inspection_Score', '{m}', NULL, CAST({v} AS DOUBLE) FROM south_clean")
    out.append("""SELECT 'Inspection_Score', 'bin', CASE WHEN Inspection_Score >= 90 THEN '90-100 (Excellent)' WHEN Inspection_Score >= 80 THEN '80-89 (Good)'
      WHEN Inspection_Score >= 70 THEN '70-79 (Fair)' WHEN Inspection_Score >= 0 THEN '0-69 (Poor)' ELSE 'No Score' END, CAST(count(*) AS DOUBLE)
      FROM south_clean GROUP BY 3""")
    out.append("SELECT 'slots', 'rows_by_filled', CAST(violation_count AS VARCHAR), CAST(count(*) AS DOUBLE) FROM south_clean GROUP BY 3")
    out.append("SELECT '*', 'rows_where', 'no_violation', CAST(count_if(violation_count = 0) AS DOUBLE) FROM south_clean")
    out.append("SELECT '*', 'rows_where', 'high_score_many', CAST(count_if(Inspection_Score >= 90 AND violation_count > 3) AS DOUBLE) FROM south_clean")
    return " UNION ALL ".join(out)


@query("profile_report", O.RAW + "SELECT * FROM (" + _pr_sql() + ")")
def profile_report(spark, d):
    m = Model(spark, d)
    clean = m.south_clean
    n = F.col("violation_count")
    out = P.profile_report(clean, _PR, frequencies=["Zip_Code"], top=5, numeric=["Inspection_Score"], score="Inspection_Score",
                           slots=[f"Violation_Description_{i}" for i in O.SLOTS],
                           rows={"no_violation": n == 0, "high_score_many": (F.col("Inspection_Score") >= 90) & (n > 3)})
    # sums of floats differ in their last digits with the order of rows
    return out.withColumn("value", F.when(F.col("metric").isin("mean", "stddev"), F.round("value", 6)).otherwise(F.col("value")))


@query("profile_stats", O.RAW + """SELECT min(Inspection_Score) AS min_value, max(Inspection_Score) AS max_value,
  avg(Inspection_Score) AS avg_value, count_if(Inspection_Score > 100) AS above_max,
  count_if(Inspection_Score IS NULL) AS null_count, count(*) AS total_rows FROM south_clean""")
def profile_stats(spark, d):
    return P.profile_stats(Model(spark, d).south_clean, "Inspection_Score")


@query("summary", O.RAW + """
SELECT 'count' AS summary, CAST(count(Inspection_Score) AS VARCHAR) AS Inspection_Score,
       CAST(count(Zip_Code) AS VARCHAR) AS Zip_Code FROM south_clean
UNION ALL SELECT 'min', CAST(min(Inspection_Score) AS VARCHAR), min(Zip_Code) FROM south_clean
UNION ALL SELECT 'max', CAST(max(Inspection_Score) AS VARCHAR), max(Zip_Code) FROM south_clean""")
def summary(spark, d):
    return P.summarize(Model(spark, d).south_clean, ["Inspection_Score", "Zip_Code"], ("count", "min", "max"))


@query("value_freq", O.RAW + "SELECT Results AS value, count(*) AS count FROM north_clean GROUP BY Results")
def value_freq(spark, d):
    return P.value_freq(Model(spark, d).north_clean, "Results")


@query("topk_freq", O.RAW + """SELECT Zip AS value, count(*) AS count FROM north_clean GROUP BY Zip
  ORDER BY count DESC, value ASC NULLS FIRST LIMIT 20""")
def topk_freq(spark, d):
    return P.topk_freq(Model(spark, d).north_clean, "Zip", 20)


@query("topk_exact", """SELECT l_partkey AS value, count(*) AS count FROM lineitem GROUP BY l_partkey
  ORDER BY count DESC, value ASC NULLS FIRST LIMIT 25""")
def topk_exact(spark, d):
    """The 25 parts with most line items, by bucket counts first."""
    return P.topk_exact(S.table(spark, d, "lineitem"), "l_partkey", 25)


@query("topk_exact_unique", "SELECT o_orderkey AS value, 1 AS count FROM orders ORDER BY o_orderkey LIMIT 20")
def topk_exact_unique(spark, d):
    """A column without repeats: all ties, the least values."""
    return P.topk_exact(S.table(spark, d, "orders"), "o_orderkey", 20)


_SKETCHED = ["l_orderkey", "l_partkey", "l_quantity", "l_returnflag", "l_extendedprice"]


@query("sketch_profile", " UNION ALL ".join(f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count(*) - count({c}) AS null_count,
  TRUE AS distinct_close, TRUE AS median_close FROM lineitem""" for c in _SKETCHED))
def sketch_profile(spark, d):
    """Profiles of each shipping month merged into one: exact counts, distinct estimates within 5 % and medians within 3 % of rank."""
    items = S.table(spark, d, "lineitem").select(*_SKETCHED, F.date_trunc("month", "l_shipdate").alias("m"))
    merged = stored(K2.estimates(K2.merge_profiles(stored(K2.sketch_profile(items, by=["m"]), "profiles"))), "estimates")
    exact = P.profile_distinct(items.select(*_SKETCHED))
    numbers = [c for c in _SKETCHED if c != "l_returnflag"]
    median = {c: merged.where(F.col("column_name") == c).select(F.col("quantiles")[1]).scalar() for c in numbers}
    at = items.agg(*[((F.count_if(F.col(c) < median[c]) / F.count("*") <= 0.53) & (F.count_if(F.col(c) <= median[c]) / F.count("*") >= 0.47)).alias(c) for c in numbers])
    ranks = at.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("median_close")) for c in numbers])))
    return (merged.join(exact, "column_name").join(ranks, "column_name", "left")
            .select("column_name", "total_rows", "null_count",
                    (F.abs(F.col("distinct_estimate") / F.col("distinct_count") - 1) <= 0.05).alias("distinct_close"),
                    F.coalesce("median_close", F.lit(True)).alias("median_close")))


@query("violations_histogram", O.RAW + """SELECT violation_count, count(*) AS count FROM south_clean
  GROUP BY violation_count""")
def violations_histogram(spark, d):
    return P.nonblank_histogram(Model(spark, d).raw_south, [f"Violation_Description_{i}" for i in O.SLOTS])


# =========================== reshaping and parsing =======================================

@query("split_explode", r"""SELECT doc_id, unnest(l) AS fragment, generate_subscripts(l, 1) AS fragment_pos
  FROM (SELECT doc_id, list_filter(list_transform(string_split_regex(text, '\n'), lambda x: trim(x)),
                                   lambda x: x <> '') AS l FROM documents)""")
def split_explode_q(spark, d):
    docs = S.table(spark, d, "documents").select("doc_id", "text")
    return split_explode(docs, "text", r"\n", out="fragment", keep=["doc_id"], with_position=True)


@query("violations_north", O.RAW[:-1] + O.north_violations_sql())
def violations_north(spark, d):
    return CL.violations_long(Model(spark, d).north_ok, V.NORTH)


@query("violations_south", O.RAW[:-1] + O.south_violations_sql())
def violations_south(spark, d):
    return CL.violations_long(Model(spark, d).south_ok, V.SOUTH)


@query("unpivot_wide", O.RAW[:-1] + O.south_long_sql() + """ SELECT Inspection_ID, violation_num,
  violation_description_raw, violation_points, violation_detail, violation_comments FROM south_long""")
def unpivot_wide(spark, d):
    from tidewater.operators.reshape import unpivot_slots
    return unpivot_slots(Model(spark, d).south_ok, "Violation",
                         {"Description": "violation_description_raw", "Points": "violation_points",
                          "Detail": "violation_detail", "Memo": "violation_comments"},
                         main_field="Description", keep=["Inspection_ID"], casts={"violation_points": "int"},
                         slot_name="violation_num")


@query("extract_code_desc", "WITH " + O.RAW_NORTH + r""" SELECT "Inspection ID" AS Inspection_ID,
  regexp_extract("Violations", '^(\d+)\.', 1) AS violation_code,
  trim(regexp_extract("Violations", '^\d+\.\s*(.+?)(?:\s*-\s*Comments:.*)?$', 1)) AS violation_description,
  trim(regexp_extract("Violations", '-\s*Comments:\s*(.*)', 1)) AS violation_comments FROM raw_north""")
def extract_code_desc(spark, d):
    r = Model(spark, d).raw_north
    return r.select("Inspection_ID", *[c.alias(n) for n, c in
                                       delimited_parts("Violations", fallback=False).items()])


# =========================== dedupe, dims, star ==========================================

@query("dedupe_first", "WITH " + O.SILVER + " SELECT * FROM viol")
def dedupe_violations(spark, d):
    return Model(spark, d).viol


@query("latest_per_key", "WITH " + O.SILVER + "," + O.staging_sql("stg2") + " SELECT * FROM stg2")
def latest_per_key(spark, d):
    return Model(spark, d).stg2


@query("dim_date", O.ALL + "SELECT * FROM dimdate")
def dim_date(spark, d):
    return Model(spark, d).dimdate


@query("dim_location", O.ALL + "SELECT * FROM loc")
def dim_location(spark, d):
    return Model(spark, d).loc


@query("dim_type", O.ALL + "SELECT * FROM typ")
def dim_type(spark, d):
    return Model(spark, d).typ


@query("dim_violation", O.ALL + "SELECT * FROM dimv")
def dim_violation(spark, d):
    return Model(spark, d).dimv


@query("fact_load", O.ALL + "SELECT * FROM fact")
def fact_load(spark, d):
    return Model(spark, d).fact


@query("fact_load_joined", O.ALL + "SELECT * FROM fact")
def fact_load_joined(spark, d):
    return Model(spark, d).fact_joined


@query("bridge_load", O.ALL + "SELECT * FROM bridge")
def bridge_load(spark, d):
    return Model(spark, d).bridge


@query("bridge_load_joined", O.ALL + "SELECT * FROM bridge")
def bridge_load_joined(spark, d):
    return Model(spark, d).bridge_joined


def _two_batches(spark, d) -> str:
    """Fact and bridge after the inspections up to the cutoff, then after all; where the tables are."""
    from tidewater.plans import incremental_star as INC
    m, base = Model(spark, d), _fresh(spark, "star")
    silver, told = _fresh(spark, "silver-inspections"), _fresh(spark, "silver-violations")
    with shuffles_dropped(spark):
        (S.silver_inspections(spark, d).withColumn("month", INC.month_of("inspection_date"))
         .write.option("compression", "zstd").partitionBy(*INC.PARTS).parquet(silver))
    insp = spark.read.parquet(silver)
    m.insp = insp.drop("month")   # the dimension reads what is written: the inspections are made once
    m.dim1 = stored(m.dim1, "dim-first")   # the first load and the second dimension read it
    with shuffles_dropped(spark):
        INC.dated(m.viol, insp).write.option("compression", "zstd").partitionBy(*INC.PARTS).parquet(told)
    viol = spark.read.parquet(told)
    first = F.col("inspection_date") < F.lit(S.SCD2_CUTOFF)
    INC.load(spark, base, insp.where(first), viol, insp.where(first), m.dim1, m.dim1.limit(0))
    INC.load(spark, base, insp, viol, insp.where(~first), m.dim2, m.dim2.where("not is_current"))
    return base


@query("fact_two_batches", O.ALL + "SELECT * FROM fact")
def fact_two_batches(spark, d):
    """The fact after two incremental loads is that of one full load."""
    from tidewater.sources.partitions import read_partitions
    return read_partitions(spark, f"{_two_batches(spark, d)}/fact_inspection").drop("month")


@query("bridge_two_batches", O.ALL + "SELECT * FROM bridge")
def bridge_two_batches(spark, d):
    from tidewater.sources.partitions import read_partitions
    return read_partitions(spark, f"{_two_batches(spark, d)}/bridge_inspection_violation").drop("month", "source_city")


@query("fact_integrity", O.ALL + """SELECT (SELECT count(*) FROM fact) AS fact_rows,
  (SELECT count(*) FROM insp) AS silver_rows,
  (SELECT count(*) FROM fact WHERE restaurant_key IS NULL) AS orphan_restaurant,
  (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM loc l WHERE l.location_key = f.location_key))
    AS orphan_location,
  (SELECT count(*) FROM fact f WHERE NOT EXISTS (SELECT 1 FROM dimdate x WHERE x.date_key = f.date_key))
    AS orphan_date,
  (SELECT count(*) FROM bridge) AS bridge_rows, (SELECT count(*) FROM viol) AS violation_rows""")
def fact_integrity(spark, d):
    m = Model(spark, d)
    # only the keys that are checked are stored: the row's own, and the three it refers by
    f = m.fact = stored(m.fact.select("inspection_key", "restaurant_key", "location_key", "date_key"), "fact-keys")
    m.viol = stored(m.viol, "violations")
    one = f.agg(F.count(F.lit(1)).alias("fact_rows"), F.count_if(F.col("restaurant_key").isNull())
                .alias("orphan_restaurant"))
    return one.select(
        "fact_rows", m.insp.agg(F.count(F.lit(1))).scalar().alias("silver_rows"), "orphan_restaurant",
        ST.orphan_keys(f, "location_key", m.loc).agg(F.count(F.lit(1))).scalar().alias("orphan_location"),
        ST.orphan_keys(f, "date_key", m.dimdate).agg(F.count(F.lit(1))).scalar().alias("orphan_date"),
        m.bridge.agg(F.count(F.lit(1))).scalar().alias("bridge_rows"),
        m.viol.agg(F.count(F.lit(1))).scalar().alias("violation_rows"))


# =========================== joins and SCD2 ==============================================

@query("anti_join_new", O.ALL + """SELECT s.* FROM stg2 s WHERE NOT EXISTS (SELECT 1 FROM dim1 t
  WHERE t.is_current AND s.restaurant_name = t.restaurant_name AND s.source_city = t.source_city
    AND coalesce(s.license_number, '') = coalesce(t.license_number, ''))""")
def anti_join_new(spark, d):
    m = Model(spark, d)
    cur = m.dim1.filter(F.col("is_current")).select(
        F.col("restaurant_name").alias("_t_name"), F.col("source_city").alias("_t_city"),
        F.coalesce(F.col("license_number"), F.lit("")).alias("_t_lic"))
    s = m.stg2
    cond = ((s["restaurant_name"] == cur["_t_name"]) & (s["source_city"] == cur["_t_city"])
            & (F.coalesce(s["license_number"], F.lit("")) == cur["_t_lic"]))
    return s.join(cur, cond, "left_anti")


@query("dup_keys", """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
  GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dup_keys(spark, d):
    return D.duplicate_keys(S.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("scd2_initial", O.ALL + f"SELECT {', '.join(DIM_OUT)} FROM dim1")
def scd2_initial(spark, d):
    return Model(spark, d).dim1.select(*DIM_OUT)


@query("scd2_merge", O.ALL + f"SELECT {', '.join(DIM_OUT)} FROM dim2")
def scd2_merge(spark, d):
    return Model(spark, d).dim2.select(*DIM_OUT)


@query("scd2_no_change", O.ALL + """SELECT count(*) AS total_rows_before, count_if(is_current) AS current_rows_before,
  count(*) AS total_rows_after, count_if(is_current) AS current_rows_after, TRUE AS unchanged FROM dim2""")
def scd2_no_change(spark, d):
    m = Model(spark, d)
    again = SCD.scd2_merge(m.dim2, m.stg2, S.RESTAURANT_KEYS, S.TRACKED, S.SCD2_AS_OF_2, S.SCD2_RUN_TS_2,
                           "load-3", nullable=S.RESTAURANT_NULLABLE, validate=False)
    return SCD.scd2_compare_totals(m.dim2, again)


@query("scd2_from_snapshots", "WITH " + O.SILVER + "," + O.SNAPSHOT_DIMS + f"\nSELECT {', '.join(DIM_OUT)} FROM {O.SNAPSHOT_LAST}")
def scd2_from_snapshots(spark, d):
    """Seven yearly snapshots in one pass; the SQL merges them one after the other."""
    return Model(spark, d).dim_years.select(*DIM_OUT)


@query("fact_as_of", "WITH " + O.SILVER + "," + O.SNAPSHOT_DIMS + "," + O.as_of_sql("dated", O.SNAPSHOT_LAST) + """
SELECT inspection_key, restaurant_key, facility_type, risk_category, inspection_result FROM dated""")
def fact_as_of(spark, d):
    """Each inspection with the restaurant version of its own date, and what that version said."""
    m = Model(spark, d)
    same = [F.col("restaurant_name"), F.col("source_city"), F.coalesce(F.col("license_number"), F.lit(""))]
    insp = m.insp.drop("facility_type", "risk_category")
    out = as_of_lookup(insp, m.dim_years, [(c, c) for c in same], "inspection_date",
                       ["restaurant_key", "facility_type", "risk_category"], backdate=True)
    return out.select(ST.inspection_key().alias("inspection_key"), "restaurant_key", "facility_type", "risk_category", "inspection_result")


@query("fact_load_as_of", "WITH " + O.SILVER + "," + O.SNAPSHOT_DIMS + "," + O.as_of_sql("dated", O.SNAPSHOT_LAST) + """
SELECT source_city, year(inspection_date) AS year, count(*) AS inspections, count(DISTINCT restaurant_key) AS versions
FROM dated GROUP BY source_city, year(inspection_date)""")
def fact_load_as_of(spark, d):
    """The fact load with versions of the inspections' dates: how many versions each year's inspections point at."""
    m = Model(spark, d)
    fact = ST.load_fact(m.insp, m.dim_years, lookup="hash", as_of_date=True)
    return (fact.groupBy("source_city", F.expr("date_key div 10000").cast("bigint").alias("year"))
            .agg(F.count("*").alias("inspections"), F.count_distinct("restaurant_key").alias("versions")))


def _three_merges(spark, d) -> str:
    """The two batches merged into a type-2 table with append-only history, then the second one once more; its path."""
    from tidewater.sinks import write_history
    from tidewater.sources.tables import read_history
    m, base = Model(spark, d), _fresh(spark, "history")
    for stg, as_of, ts, job in ((m.stg1, S.SCD2_AS_OF_1, S.SCD2_RUN_TS_1, S.SCD2_JOB_1), (m.stg2, S.SCD2_AS_OF_2, S.SCD2_RUN_TS_2, S.SCD2_JOB_2),
                                (m.stg2, S.SCD2_AS_OF_2, S.SCD2_RUN_TS_2, "load-3")):
        write_history(spark, SCD.scd2_merge(read_history(spark, base, current_only=True), stg, S.RESTAURANT_KEYS, S.TRACKED, as_of, ts, job,
                                            nullable=S.RESTAURANT_NULLABLE, validate=False), base)
    return base


@query("scd2_append_only", O.ALL + f"SELECT {', '.join(DIM_OUT)} FROM dim2")
def scd2_append_only(spark, d):
    """The type-2 table as its append-only folders give it after three merges."""
    from tidewater.sources.tables import read_history
    return read_history(spark, _three_merges(spark, d)).select(*DIM_OUT)


@query("scd2_rows_written", O.ALL + """SELECT 1 AS version, count(*) AS current_rows, 0 AS closed_rows FROM dim1
UNION ALL SELECT 2, count_if(is_current), count_if(NOT is_current) FROM dim2
UNION ALL SELECT 3, count_if(is_current), 0 FROM dim2""")
def scd2_rows_written(spark, d):
    """What each merge wrote: a merge without changes closes nothing and writes no closed row."""
    from tidewater.sources.tables import history_log
    return history_log(spark, _three_merges(spark, d)).select("version", "current_rows", "closed_rows")


@query("scd2_state", O.ALL + "SELECT is_current, count(*) AS row_count FROM dim2 GROUP BY is_current")
def scd2_state(spark, d):
    return SCD.scd2_state(Model(spark, d).dim2)


@query("scd2_totals", O.ALL + """SELECT count(*) AS total_rows, count_if(is_current) AS current_rows,
  count_if(NOT is_current) AS expired_rows FROM dim2""")
def scd2_totals(spark, d):
    return SCD.scd2_totals(Model(spark, d).dim2)


@query("scd2_history", O.ALL + f"""SELECT {', '.join('x.' + c for c in DIM_OUT)} FROM dim2 x JOIN (
  SELECT restaurant_name, source_city, coalesce(license_number, '') AS lic FROM dim2
  GROUP BY restaurant_name, source_city, coalesce(license_number, '') HAVING count(*) > 1) g
  ON x.restaurant_name = g.restaurant_name AND x.source_city = g.source_city
 AND coalesce(x.license_number, '') = g.lic""")
def scd2_history(spark, d):
    return SCD.scd2_history(Model(spark, d).dim2, S.RESTAURANT_KEYS, S.RESTAURANT_NULLABLE).select(*DIM_OUT)


@query("semi_history", O.ALL + f"""SELECT {', '.join(DIM_OUT)} FROM dim2 WHERE is_current AND
  (restaurant_name, source_city, coalesce(license_number, '')) IN (
    SELECT (restaurant_name, source_city, coalesce(license_number, '')) FROM dim2
    GROUP BY restaurant_name, source_city, coalesce(license_number, '') HAVING count(*) > 1)""")
def semi_history(spark, d):
    """Current rows whose business key has more than one version (tuple IN -> left semi)."""
    dim = Model(spark, d).dim2
    return SCD.scd2_history(dim, S.RESTAURANT_KEYS, S.RESTAURANT_NULLABLE).filter(F.col("is_current")).select(*DIM_OUT)


@query("scd2_change_detail", O.ALL + """, h AS (SELECT *, row_number() OVER (PARTITION BY restaurant_name,
  source_city, coalesce(license_number, '') ORDER BY effective_start_date DESC, is_current DESC,
  effective_end_date DESC, restaurant_key DESC) AS rn FROM dim2)
SELECT n.restaurant_name, n.source_city, n.license_number,
  o.facility_type AS old_facility_type, n.facility_type AS new_facility_type,
  o.risk_category AS old_risk_category, n.risk_category AS new_risk_category,
  o.aka_name AS old_aka_name, n.aka_name AS new_aka_name,
  o.effective_start_date AS old_start, o.effective_end_date AS old_end,
  n.effective_start_date AS new_start, n.effective_end_date AS new_end
FROM h n JOIN h o ON n.restaurant_name = o.restaurant_name AND n.source_city = o.source_city
  AND coalesce(n.license_number, '') = coalesce(o.license_number, '') AND n.rn = 1 AND o.rn = 2""")
def scd2_change_detail(spark, d):
    return SCD.scd2_change_detail(Model(spark, d).dim2, S.RESTAURANT_KEYS, S.TRACKED, S.RESTAURANT_NULLABLE)


@query("scd2_checks", O.ALL + """, k AS (SELECT count_if(is_current) AS n_current,
  count_if(NOT is_current AND effective_end_date = DATE '9999-12-31') AS bad_expired,
  count_if(is_current AND effective_end_date <> DATE '9999-12-31') AS bad_current
  FROM dim2 GROUP BY restaurant_name, source_city, coalesce(license_number, '')),
c AS (SELECT count_if(n_current > 1) AS c1, count_if(n_current = 0) AS c2, coalesce(sum(bad_expired), 0) AS c3,
  coalesce(sum(bad_current), 0) AS c4 FROM k)
SELECT 'multiple_current_rows' AS check_name, CAST(c1 AS BIGINT) AS failures, c1 = 0 AS passed FROM c
UNION ALL SELECT 'no_current_row', CAST(c2 AS BIGINT), c2 = 0 FROM c
UNION ALL SELECT 'expired_with_open_end', CAST(c3 AS BIGINT), c3 = 0 FROM c
UNION ALL SELECT 'current_not_open_end', CAST(c4 AS BIGINT), c4 = 0 FROM c""")
def scd2_checks(spark, d):
    return SCD.scd2_checks(Model(spark, d).dim2, S.RESTAURANT_KEYS, S.RESTAURANT_NULLABLE)


@query("scd2_as_of", O.ALL + f"""SELECT {', '.join(DIM_OUT)} FROM dim2 WHERE effective_start_date <= DATE '2000-06-30'
  AND (DATE '2000-06-30' < effective_end_date OR is_current)""")
def scd2_as_of(spark, d):
    import datetime as dt
    return SCD.as_of(Model(spark, d).dim2, dt.date(2000, 6, 30)).select(*DIM_OUT)


@query("copies_keep_violations", O.RAW.replace("raw_south AS (", "raw_once AS (", 1).replace("south_clean AS (", """
raw_south AS (SELECT * FROM raw_once UNION ALL SELECT * FROM raw_once WHERE "Violation Description - 2" = 'Flag R'),
south_clean AS (""", 1)[:-1] + O.south_long_sql() + """ SELECT violation_description_raw, count(*) AS violations,
  count(DISTINCT Inspection_ID) AS inspections FROM south_long GROUP BY violation_description_raw""")
def copies_keep_violations(spark, d):
    """Exact copies of a raw row are inspections of their own and keep all their violations."""
    from tidewater.operators.reshape import unpivot_slots
    raw = Model(spark, d).raw_south
    raw = raw.unionByName(raw.filter(F.col("Violation_Description_2") == "Flag R"))
    ok = Q.apply_rules(V.south_clean(raw), V.south_rules())
    long = unpivot_slots(ok, "Violation", {"Description": "violation_description_raw"}, main_field="Description",
                         keep=["Inspection_ID"], casts={}, slot_name="violation_num")
    return long.groupBy("violation_description_raw").agg(F.count("*").alias("violations"),
                                                         F.count_distinct(F.unhex("Inspection_ID")).alias("inspections"))  # 16 bytes each


_ABA = O.merge_sql("dim3", "dim2", "stg_b", S.SCD2_AS_OF_2, S.SCD2_JOB_2) + "," \
    + O.merge_sql("dim4", "dim3", "stg2", S.SCD2_AS_OF_2, S.SCD2_JOB_2)


@query("scd2_same_day_aba", O.ALL + """, stg_b AS (SELECT * REPLACE ('B' AS facility_type) FROM stg2
  WHERE source_city = 'north'),""" + _ABA + """
SELECT source_city, is_current, facility_type = 'B' AS is_b, count(*) AS versions,
  count(DISTINCT restaurant_key) AS version_keys FROM dim4 GROUP BY 1, 2, 3""")
def scd2_same_day_aba(spark, d):
    """A value that changes and comes back on one day under one job: three versions, three keys."""
    m = Model(spark, d)
    stg_b = m.stg2.filter(F.col("source_city") == S.NORTH).withColumn("facility_type", F.lit("B"))
    args = (S.RESTAURANT_KEYS, S.TRACKED, S.SCD2_AS_OF_2, S.SCD2_RUN_TS_2, S.SCD2_JOB_2)
    dim3 = SCD.scd2_merge(m.dim2, stg_b, *args, nullable=S.RESTAURANT_NULLABLE)
    dim4 = SCD.scd2_merge(dim3, m.stg2, *args, nullable=S.RESTAURANT_NULLABLE)
    return dim4.groupBy("source_city", "is_current", (F.col("facility_type") == "B").alias("is_b")).agg(
        F.count("*").alias("versions"), F.count_distinct("restaurant_key").alias("version_keys"))


@query("fact_blank_licence", "WITH " + O.SILVER + """, south_mixed AS (SELECT * REPLACE (
  CASE WHEN inspection_type = 'Routine' THEN '' ELSE license_number END AS license_number) FROM insp
  WHERE source_city = 'south')
SELECT count(*) AS fact_rows, count(DISTINCT inspection_id) AS inspections,
  count(DISTINCT restaurant_name) AS restaurant_keys FROM south_mixed""")
def fact_blank_licence(spark, d):
    """Rows of one business with NULL and with blank licence: one dimension row, no fan-out of the fact."""
    m = Model(spark, d)
    insp = m.insp.filter(F.col("source_city") == S.SOUTH).withColumn(
        "license_number", F.when(F.col("inspection_type") == "Routine", F.lit("")).otherwise(F.col("license_number")))
    dim = SCD.scd2_merge(None, S.staging_restaurants(insp), S.RESTAURANT_KEYS, S.TRACKED, S.SCD2_AS_OF_1, S.SCD2_RUN_TS_1,
                         S.SCD2_JOB_1, nullable=S.RESTAURANT_NULLABLE)
    return ST.load_fact(insp, dim, lookup="hash").agg(
        F.count("*").alias("fact_rows"), F.count_distinct("inspection_id").alias("inspections"),
        F.count_distinct("restaurant_key").alias("restaurant_keys"))


_KEYS = [("dim_restaurant", "dim2", "restaurant_key"), ("dim_location", "loc", "location_key"),
         ("dim_inspection_type", "typ", "inspection_type_key"), ("dim_violation", "dimv", "violation_key"),
         ("fact_inspection", "fact", "inspection_key")]


@query("key_uniqueness", O.ALL + " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS row_count, count(*) AS key_count FROM {t}" for n, t, _ in _KEYS))
def key_uniqueness(spark, d):
    m = Model(spark, d)
    out = [getattr(m, t).agg(F.count("*").alias("row_count"), F.count_distinct(k).alias("key_count"))
           .select(F.lit(n).alias("table_name"), "row_count", "key_count") for n, t, k in _KEYS]
    return reduce(DataFrame.unionByName, out)


# ---- the manual SCD2 test as a query: pick candidates, change them, merge, look up ----

SCD2_TEST_AS_OF = __import__("datetime").date(2001, 12, 15)
SCD2_TEST_TS = __import__("datetime").datetime(2001, 12, 15, 6, 0, 0)


def scd2_test_batch(stg: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(change batch, picked keys): pick 5 candidates (equality, NOT NULL, NOT LIKE, order,
    limit 5), then #1 changes one attribute, #2 changes two, #3 is cloned as a new business."""
    from pyspark.sql import Window
    cands = (stg.filter((F.col("source_city") == S.NORTH) & F.col("license_number").isNotNull()
                        & F.col("facility_type").isNotNull() & ~F.col("restaurant_name").like("%000000000%"))
             .orderBy("restaurant_name").limit(5))
    # 5 rows: numbering them in one partition is bounded work
    picks = cands.withColumn("pick", F.row_number().over(Window.orderBy("restaurant_name")))
    changed = C.overlay_by_frame(
        stg, picks.select(*S.RESTAURANT_KEYS, "pick"), S.RESTAURANT_KEYS,
        {"facility_type": F.when(F.col("pick") == 1, F.lit("SCD2_TEST_BAKERY")).otherwise(F.col("facility_type")),
         "risk_category": F.when(F.col("pick") == 2, F.lit("Risk 3 (Low)")).otherwise(F.col("risk_category")),
         "aka_name": F.when(F.col("pick") == 2, F.lit("SCD2_TEST_AKA_NAME")).otherwise(F.col("aka_name"))},
        broadcast_picks=True)   # at most 5 rows: the pick is limit(5)
    clone = C.with_overrides(picks.filter(F.col("pick") == 3).select(*S.STAGING_COLS),
                             {"restaurant_name": "SCD2_TEST_NEW_RESTAURANT", "license_number": "9999999"})
    touched = picks.filter(F.col("pick") <= 2).select("restaurant_name").unionByName(
        clone.select("restaurant_name"))
    return changed.unionByName(clone), touched


@query("scd2_test_changes", O.ALL + """, cands AS (
  SELECT *, row_number() OVER (ORDER BY restaurant_name) AS pick FROM (
    SELECT * FROM stg2 WHERE source_city = 'north' AND license_number IS NOT NULL AND facility_type IS NOT NULL
      AND restaurant_name NOT LIKE '%000000000%' ORDER BY restaurant_name LIMIT 5)),
stg3 AS (
  SELECT s.restaurant_name,
         CASE WHEN c.pick = 2 THEN 'SCD2_TEST_AKA_NAME' ELSE s.aka_name END AS aka_name, s.license_number,
         CASE WHEN c.pick = 1 THEN 'SCD2_TEST_BAKERY' ELSE s.facility_type END AS facility_type,
         CASE WHEN c.pick = 2 THEN 'Risk 3 (Low)' ELSE s.risk_category END AS risk_category, s.source_city
  FROM stg2 s LEFT JOIN cands c ON s.restaurant_name IS NOT DISTINCT FROM c.restaurant_name
   AND s.source_city IS NOT DISTINCT FROM c.source_city AND s.license_number IS NOT DISTINCT FROM c.license_number
  UNION ALL
  SELECT 'SCD2_TEST_NEW_RESTAURANT', aka_name, '9999999', facility_type, risk_category, source_city
  FROM cands WHERE pick = 3),""" + O.merge_sql("dim3", "dim2", "stg3", SCD2_TEST_AS_OF, "load-test") + f"""
SELECT {', '.join(DIM_OUT)} FROM dim3 WHERE restaurant_name IN (
  SELECT restaurant_name FROM cands WHERE pick <= 2 UNION ALL SELECT 'SCD2_TEST_NEW_RESTAURANT')""")
def scd2_test_changes(spark, d):
    m = Model(spark, d)
    batch, touched = scd2_test_batch(m.stg2)
    dim3 = SCD.scd2_merge(m.dim2, batch, S.RESTAURANT_KEYS, S.TRACKED, SCD2_TEST_AS_OF, SCD2_TEST_TS,
                          "load-test", nullable=S.RESTAURANT_NULLABLE, validate=False)
    # point lookup of the touched businesses (at most 3 names, derived from the 5-row pick)
    return dim3.join(F.broadcast(touched), "restaurant_name", "left_semi").select(*DIM_OUT)


# =========================== reports =====================================================

_YEAR = "CAST(date_key // 10000 AS INTEGER)"


@query("kpi", O.ALL + """SELECT count(*) AS inspections, count(DISTINCT restaurant_key) AS restaurants,
  CAST(count_if(inspection_result = 'Pass') AS DOUBLE) * 100 / count(*) AS pass_rate_pct FROM fact""")
def kpi(spark, d):
    return R.kpi(Model(spark, d).fact)


_CUBE_NULLS = {"source_city": "VARCHAR", "inspection_result": "VARCHAR", "year": "INTEGER", "risk_category": "VARCHAR", "facility_type": "VARCHAR",
               "score_bucket": "INTEGER", "inspection_type_name": "VARCHAR"}


def _cube_sql() -> str:
    parts = []
    for name, cols in R.CUBE.items():
        picked = ", ".join(c if c in cols else f"CAST(NULL AS {t}) AS {c}" for c, t in _CUBE_NULLS.items())
        group = f" GROUP BY {', '.join(cols)}" if cols else ""
        parts.append(f"SELECT '{name}' AS report, {picked}, count(*) AS inspections FROM flat{group}")
    return O.ALL[:-1] + """, flat AS (SELECT f.source_city, f.inspection_result, CAST(f.date_key // 10000 AS INTEGER) AS year, r.risk_category, r.facility_type,
  CAST(floor(f.inspection_score / 5) * 5 AS INTEGER) AS score_bucket, t.inspection_type_name
  FROM fact f LEFT JOIN dim2 r ON f.restaurant_key = r.restaurant_key LEFT JOIN typ t ON f.inspection_type_key = t.inspection_type_key)
""" + " UNION ALL ".join(parts)


@query("report_cube", _cube_sql())
def report_cube(spark, d):
    """All report groupings from one scan of the fact."""
    m = Model(spark, d)
    return R.report_cube(m.fact, m.dim2, m.typ)


@query("results_by_group", O.ALL + """SELECT source_city, inspection_result, count(*) AS inspections FROM fact
  GROUP BY source_city, inspection_result""")
def results_by_group(spark, d):
    return R.results_by_group(Model(spark, d).fact)


@query("by_year", O.ALL + """SELECT x.year, f.source_city, count(*) AS inspections FROM fact f
  JOIN dimdate x ON f.date_key = x.date_key GROUP BY x.year, f.source_city""")
def by_year(spark, d):
    m = Model(spark, d)
    return R.by_year(m.fact, m.dimdate)


@query("risk_share", O.ALL + """SELECT r.risk_category, count(*) AS inspections,
  CAST(count(*) AS DOUBLE) * 100 / (SELECT count(*) FROM fact) AS share_pct
  FROM fact f LEFT JOIN dim2 r ON f.restaurant_key = r.restaurant_key GROUP BY r.risk_category""")
def risk_share(spark, d):
    m = Model(spark, d)
    return R.risk_share(m.fact, m.dim2)


@query("top_types", O.ALL + """SELECT r.facility_type, count(*) AS inspections FROM fact f
  LEFT JOIN dim2 r ON f.restaurant_key = r.restaurant_key GROUP BY r.facility_type
  ORDER BY inspections DESC, facility_type ASC NULLS FIRST LIMIT 10""")
def top_facility_types(spark, d):
    m = Model(spark, d)
    return R.top_facility_types(m.fact, m.dim2)


@query("score_hist", O.ALL + """SELECT CAST(floor(inspection_score / 5) * 5 AS INTEGER) AS score_bucket,
  count(*) AS inspections FROM fact WHERE inspection_score IS NOT NULL AND source_city = 'south' GROUP BY 1""")
def score_hist(spark, d):
    return R.score_histogram(Model(spark, d).fact, 5, S.SOUTH)


@query("by_type", O.ALL + """SELECT t.source_city, t.inspection_type_name, count(*) AS inspections FROM fact f
  LEFT JOIN typ t ON f.inspection_type_key = t.inspection_type_key GROUP BY t.source_city, t.inspection_type_name""")
def by_type(spark, d):
    m = Model(spark, d)
    return R.by_type(m.fact, m.typ)


@query("top_codes", O.ALL + """SELECT dv.violation_code, count(*) AS citations FROM bridge b
  LEFT JOIN dimv dv ON b.violation_key = dv.violation_key GROUP BY dv.violation_code
  ORDER BY citations DESC, violation_code ASC NULLS FIRST LIMIT 15""")
def top_codes(spark, d):
    m = Model(spark, d)
    return R.top_violation_codes(m.bridge, m.dimv)


@query("pass_rate_trend", O.ALL + f"""SELECT {_YEAR} AS year, source_city, count(*) AS inspections,
  CAST(count_if(inspection_result = 'Pass') AS DOUBLE) * 100 / count(*) AS pass_rate_pct FROM fact GROUP BY 1, 2""")
def pass_rate_trend(spark, d):
    return R.pass_rate_trend(Model(spark, d).fact)


@query("lowest_year", O.ALL + f""", t AS (SELECT {_YEAR} AS year, source_city,
  CAST(count_if(inspection_result = 'Pass') AS DOUBLE) * 100 / count(*) AS pass_rate_pct FROM fact GROUP BY 1, 2)
SELECT source_city, year, pass_rate_pct FROM (SELECT *, row_number() OVER (PARTITION BY source_city
  ORDER BY pass_rate_pct, year) AS rn FROM t) WHERE rn = 1""")
def lowest_year(spark, d):
    return R.lowest_pass_rate_year(Model(spark, d).fact)


@query("avg_score_year", O.ALL + f"""SELECT {_YEAR} AS year, avg(inspection_score) AS avg_score,
  count(inspection_score) AS scored FROM fact GROUP BY 1""")
def avg_score_year(spark, d):
    return R.avg_score_by_year(Model(spark, d).fact)


@query("top_entities", O.ALL + """SELECT r.restaurant_name, r.source_city, count(*) AS inspections FROM fact f
  JOIN dim2 r ON f.restaurant_key = r.restaurant_key GROUP BY r.restaurant_key, r.restaurant_name, r.source_city
  ORDER BY inspections DESC, restaurant_name, source_city LIMIT 10""")
def top_entities(spark, d):
    m = Model(spark, d)
    return R.top_entities(m.fact, m.dim2)


@query("geo_points", O.ALL + """SELECT l.latitude, l.longitude, l.city, count(*) AS inspections FROM fact f
  JOIN loc l ON f.location_key = l.location_key GROUP BY l.latitude, l.longitude, l.city""")
def geo_points(spark, d):
    m = Model(spark, d)
    return R.geo_points(m.fact, m.loc)


@query("denormalized", O.ALL + """SELECT f.inspection_id, f.source_city, r.restaurant_name, r.facility_type,
  r.risk_category, l.address, l.city, l.state, l.zip, l.latitude, l.longitude, t.inspection_type_name,
  x.full_date, x.year, x.month, f.inspection_result, f.inspection_score
FROM fact f LEFT JOIN dim2 r ON f.restaurant_key = r.restaurant_key
  LEFT JOIN loc l ON f.location_key = l.location_key
  LEFT JOIN typ t ON f.inspection_type_key = t.inspection_type_key
  LEFT JOIN dimdate x ON f.date_key = x.date_key""")
def denormalized(spark, d):
    m = Model(spark, d)
    return R.denormalized(m.fact, m.dim2, m.loc, m.typ, m.dimdate)


@query("summary_risk_facility", O.ALL + """SELECT r.risk_category, r.facility_type, count(*) AS inspections,
  CAST(count_if(f.inspection_result = 'Pass') AS DOUBLE) * 100 / count(*) AS pass_rate_pct
  FROM fact f LEFT JOIN dim2 r ON f.restaurant_key = r.restaurant_key GROUP BY r.risk_category, r.facility_type""")
def summary_risk_facility(spark, d):
    m = Model(spark, d)
    return R.summary_risk_facility(m.fact, m.dim2)


# =========================== sinks, catalog and samples ==================================

_EXTRACTS = {"fact_inspections_denormalized": "fact", "summary_results_by_year": "per_year", "summary_risk_facility": "risk",
             "summary_top_violations": "top"}


@query("bi_extracts", O.ALL + f""", per_year AS (SELECT {_YEAR} AS year, source_city, count(*) AS n FROM fact GROUP BY 1, 2),
risk AS (SELECT r.risk_category, r.facility_type, count(*) AS n FROM fact f LEFT JOIN dim2 r ON f.restaurant_key = r.restaurant_key GROUP BY 1, 2),
top AS (SELECT dv.violation_code, count(*) AS n FROM bridge b LEFT JOIN dimv dv ON b.violation_key = dv.violation_key GROUP BY 1
        ORDER BY n DESC, 1 ASC NULLS FIRST LIMIT 15)
""" + " UNION ALL ".join(f"""SELECT '{name}' AS extract, count(*) AS row_count,
  CAST({'count(*)' if t == 'fact' else 'sum(n)'} AS BIGINT) AS counted FROM {t}""" for name, t in _EXTRACTS.items()))
def bi_extracts(spark, d):
    """The denormalised fact and three summaries written as extracts and read back: rows, and what they count."""
    import datetime as dt

    from tidewater.config import RunConfig
    from tidewater.plans.pipeline import extracts
    from tidewater.sinks import write_table
    from tidewater.sources.csv import read_csv
    m, base, gold = Model(spark, d), _fresh(spark, "gold"), {}
    m.viol = stored(m.viol, "violations")
    for name, attr in (("dim_restaurant", "dim2"), *_COUNTS):  # the fact reads the dimension, the bridge the fact, from what is written
        if name not in gold:
            gold[name] = write_table(getattr(m, attr), f"{base}/{name}")
            setattr(m, attr, spark.read.parquet(gold[name]))
    cfg = RunConfig(base, job_id="extract-job", as_of=dt.date(2001, 12, 1), run_ts=_RT_TS)
    out = []
    for name, path in extracts(spark, cfg, gold).items():
        back = spark.read.parquet(path) if name.startswith("fact") else read_csv(spark, path)
        n = next((F.col(c).cast("bigint") for c in ("inspections", "citations") if c in back.columns), F.lit(1))
        out.append(back.agg(F.count(F.lit(1)).alias("row_count"), F.sum(n).cast("bigint").alias("counted"))
                   .select(F.lit(name).alias("extract"), "row_count", "counted"))
    return reduce(DataFrame.unionByName, out)


@query("gold_lineage", O.ALL + """SELECT location_key, source_city, TIMESTAMP '2001-12-01 06:00:00' AS created_at,
  TIMESTAMP '2001-12-01 06:00:00' AS updated_at, 'gold-job' AS etl_job_id FROM loc""")
def gold_lineage(spark, d):
    return C.add_gold_lineage(Model(spark, d).loc.select("location_key", "source_city"), "gold-job", _RT_TS)


@query("drop_by_prefix", "WITH " + O.RAW_SOUTH + " SELECT " + ", ".join(
    f'"{c}" AS {O._san(c)}' for c in O.RAW_SOUTH_COLS if not c.startswith("Violation ") and c != "Lat Long Location") + " FROM raw_south")
def drop_by_prefix(spark, d):
    """Columns dropped by prefix and by name; a name that does not exist is passed over."""
    return C.drop_columns(Model(spark, d).raw_south, prefixes=["Violation_"], names=["Lat_Long_Location", "No_Such_Column"])


_LISTED = ["nation", "part", "supplier"]


@query("layer_namespace", " UNION ALL ".join(
    f"SELECT 'bronze_{t}' AS table_name, '{m}' AS load, count(*) AS row_count FROM {t}"
    for t, m in zip(_LISTED, ("merge", "merge", "first_load"))))
def layer_namespace(spark, d):
    """A namespace with bronze tables, listed by pattern; ``load``: what the next load of each would do.

    One of the tables was left there in another format, so it is dropped and loaded anew.
    """
    import uuid

    from tidewater.sinks import ensure_namespace, load_mode, save_as_table
    from tidewater.sources.tables import list_tables, read_table
    db = ensure_namespace(spark, f"layer_{uuid.uuid4().hex}")
    for t in _LISTED:
        save_as_table(S.table(spark, d, t), f"{db}.bronze_{t}", fmt="json" if t == "supplier" else "parquet")
    save_as_table(S.table(spark, d, "region"), f"{db}.silver_region")
    loads = {}
    for t in _LISTED:
        loads[f"bronze_{t}"] = load_mode(spark, f"{db}.bronze_{t}")
        if loads[f"bronze_{t}"] == "first_load":
            save_as_table(S.table(spark, d, t), f"{db}.bronze_{t}")
    listed = list_tables(spark, db, "bronze_*", include_temporary=False).select(F.col("tableName").alias("table_name"))
    counts = reduce(DataFrame.unionByName, [
        read_table(spark, f"{db}.{name}").agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), F.lit(load).alias("load"), "row_count") for name, load in loads.items()])
    return listed.join(counts, "table_name", "left").select("table_name", "load", "row_count")


@query("temp_view_sql", "SELECT s_nationkey, count(*) AS suppliers, max(s_acctbal) AS top_balance FROM supplier GROUP BY s_nationkey")
def temp_view_sql(spark, d):
    """A staged frame under a name of its own, read by SQL."""
    import uuid

    from tidewater.sinks import register_view
    view = register_view(S.table(spark, d, "supplier").select("s_nationkey", "s_acctbal"), f"staging_{uuid.uuid4().hex}")
    return spark.sql(f"SELECT s_nationkey, count(*) AS suppliers, max(s_acctbal) AS top_balance FROM {view} GROUP BY s_nationkey")


_CONCEPTS = [("restaurant_name", "DBA_Name", "Restaurant_Name"), ("aka_name", "AKA_Name", None), ("address", "Address", "Street_Address"),
             ("zip", "Zip", "Zip_Code"), ("inspection_type", "Inspection_Type", "Inspection_Type"),
             ("inspection_date", "Inspection_Date", "Inspection_Date")]


def _filled_sql(table: str, column: str | None) -> str:
    return "CAST(NULL AS BIGINT)" if column is None else f"(SELECT count({column}) FROM {table})"


@query("attribute_map", O.RAW + " UNION ALL ".join(
    f"""SELECT '{c}' AS concept, {f"'{a}'" if a else 'NULL'} AS north_column, {f"'{b}'" if b else 'NULL'} AS south_column,
  {_filled_sql('north_clean', a)} AS north_filled, {_filled_sql('south_clean', b)} AS south_filled""" for c, a, b in _CONCEPTS))
def attribute_map_filled(spark, d):
    """Source-to-target map by concept, with how many values each source column holds; one aggregate a source."""
    from tidewater.config import attribute_map
    m = Model(spark, d)
    rows = attribute_map(SourceMapping("north", {c: a for c, a, _ in _CONCEPTS}), SourceMapping("south", {c: b for c, _, b in _CONCEPTS}))
    filled = []
    for frame, side in ((m.north_clean, "left"), (m.south_clean, "right")):
        at = [(r.concept, getattr(r, side)) for r in rows]
        one = frame.agg(*[(F.lit(None).cast("bigint") if c is None else F.count(c)).alias(n) for n, c in at])
        out = "north" if side == "left" else "south"
        filled.append(one.select(F.inline(F.array(*[F.struct(
            F.lit(n).alias("concept"), F.lit(c).cast("string").alias(f"{out}_column"), F.col(n).alias(f"{out}_filled")) for n, c in at]))))
    return filled[0].join(filled[1], "concept")


@query("lineage_sample", "SELECT 'north' AS data_source_name, TIMESTAMP '2001-12-01 06:00:00' AS ingest_timestamp, 'bronze-job' AS etl_job_id "
       "FROM orders LIMIT 5")
def lineage_sample(spark, d):
    """The lineage columns of five rows."""
    df = C.add_bronze_lineage(Model(spark, d).raw_north, "north", job_id="bronze-job", run_ts=_RT_TS)
    return df.select("data_source_name", "ingest_timestamp", "etl_job_id").limit(5)


@query("quarantine_sample", O.RAW + f"""SELECT Inspection_ID, {_dq_case(O.NORTH_ERRORS)} AS errors FROM north_clean
  WHERE {_any_null(O.NORTH_ERRORS + O.NORTH_WARNINGS)} ORDER BY Inspection_ID NULLS FIRST LIMIT 20""")
def quarantine_sample(spark, d):
    """Twenty quarantined rows, by id."""
    _, quarantine = Q.dq_split(Model(spark, d).north_clean, V.north_checks())
    return quarantine.select("Inspection_ID", F.array_join("_errors", ",").alias("errors")).orderBy("Inspection_ID").limit(20)


@query("violations_sample", O.RAW + """SELECT Inspection_ID, Violations FROM north_clean WHERE Violations IS NOT NULL
  ORDER BY Inspection_ID NULLS FIRST LIMIT 5""")
def violations_sample(spark, d):
    """Five rows that have violations, by id."""
    return Model(spark, d).north_clean.filter("Violations IS NOT NULL").select("Inspection_ID", "Violations").orderBy("Inspection_ID").limit(5)


def queries() -> dict[str, Builder]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
