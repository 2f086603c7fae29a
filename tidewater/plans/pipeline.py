"""End-to-end batch job: raw -> bronze -> silver -> gold, each layer written as Parquet.

Layers talk only through written tables, which also cuts lineage (a lost executor
recomputes from the last written layer, never from the raw files). Counts come from
the written tables (metadata-cheap Parquet scans), not from re-running plans.

Conformance of the two silver shapes onto one inspection schema is config
(``SourceMapping``), so a third source is a mapping, not code.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructType

from tidewater.config import RunConfig, SourceMapping
from tidewater.operators import cleanse as CL
from tidewater.operators import columns as C
from tidewater.operators import dims as D
from tidewater.operators import quality as Q
from tidewater.operators import scd2 as SCD
from tidewater.operators import star as ST
from tidewater.plans import silver as V
from tidewater.plans import standin as S
from tidewater.sinks import write_history, write_snapshot, write_table
from tidewater.sources.csv import read_csv
from tidewater.sources.tables import HISTORY, read_history, read_table

INSPECTION_SCHEMA = [
    ("inspection_id", StringType()), ("restaurant_name", StringType()), ("aka_name", StringType()),
    ("license_number", StringType()), ("facility_type", StringType()), ("risk_category", StringType()),
    ("address", StringType()), ("city", StringType()), ("state", StringType()), ("zip", StringType()),
    ("latitude", DoubleType()), ("longitude", DoubleType()), ("inspection_date", DateType()),
    ("inspection_type", StringType()), ("inspection_result", StringType()), ("inspection_score", IntegerType()),
    ("source_city", StringType())]

NORTH_MAP = SourceMapping("north", {
    "inspection_id": "Inspection_ID", "restaurant_name": "DBA_Name", "aka_name": "AKA_Name",
    "license_number": "License", "facility_type": "Facility_Type", "risk_category": "Risk",
    "address": "Address", "city": "City", "state": "State", "zip": "Zip", "latitude": "Latitude",
    "longitude": "Longitude", "inspection_date": "Inspection_Date", "inspection_type": "Inspection_Type",
    "inspection_result": "Results", "inspection_score": "Inspection_Score", "source_city": "source_city"})

SOUTH_MAP = SourceMapping("south", {
    "inspection_id": "Inspection_ID", "restaurant_name": "Restaurant_Name", "aka_name": None,
    "license_number": None, "facility_type": None, "risk_category": None, "address": "Street_Address",
    "city": "City", "state": "State", "zip": "Zip_Code", "latitude": "Latitude", "longitude": "Longitude",
    "inspection_date": "Inspection_Date", "inspection_type": "Inspection_Type",
    "inspection_result": "Results", "inspection_score": "Inspection_Score", "source_city": "source_city"})

VIOLATION_COLS = ["inspection_id", "violation_code", "violation_description", "violation_comments",
                  "violation_points", "source_city"]


def _viol(df: DataFrame) -> DataFrame:
    return df.select(F.col("Inspection_ID").cast("string").alias("inspection_id"), *VIOLATION_COLS[1:])


def ingest(spark: SparkSession, path: str | list[str], schema: StructType | None, source: str, cfg: RunConfig,
           multiline: bool = True) -> str:
    """CSV files of one source -> sanitised names + lineage -> bronze table; its path."""
    raw = C.sanitize_columns(read_csv(spark, path, schema=schema, multiline=multiline))
    return write_table(C.add_bronze_lineage(raw, source, cfg.job_id, cfg.run_ts), f"{cfg.layer('bronze')}/{source}_inspections")


def bronze(spark: SparkSession, sf_dir: str, cfg: RunConfig, counts: dict[str, dict] | None = None) -> dict[str, str]:
    """Raw sources -> sanitised names + lineage -> Parquet (full refresh); the two
    sources' jobs run concurrently."""
    def one(name, raw):
        df = C.add_bronze_lineage(C.sanitize_columns(raw), name, cfg.job_id, cfg.run_ts)
        path = write_table(df, f"{cfg.layer('bronze')}/{name}_inspections", counts=counts)
        if cfg.snapshot:
            write_snapshot(df, f"{cfg.base_path}/snapshots", f"bronze_{name}", cfg.run_ts, cfg.run_id)
        return name, path

    sources = [("north", S.raw_north(spark, sf_dir)), ("south", S.raw_south(spark, sf_dir))]
    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        return dict(pool.map(lambda a: one(*a), sources))


def silver(spark: SparkSession, cfg: RunConfig, counts: dict[str, dict] | None = None) -> dict[str, str]:
    """Bronze -> cleanse -> rules -> inspections, violations, quarantine and rule audit.

    The expensive per-row work (cleansing + every rule) runs ONCE: cleansed rows are
    written with the rules each fails, and the four outputs are column-pruned re-reads
    of that table (only passing rows go on). The rule audit comes from metrics that are
    observed while the flagged rows are written, without reading them again.
    """
    counts = {} if counts is None else counts
    b = cfg.layer("bronze")
    s = cfg.layer("silver")

    def one(name, cleanse, rules, viol_fn, keys) -> dict[str, str]:
        out = {}
        flagged_path = f"{s}/{name}_flagged"
        write_table(Q.flag_rules(cleanse(spark.read.parquet(f"{b}/{name}_inspections")), rules), flagged_path,
                    counts=counts, metrics=Q.audit_metrics(rules))
        flagged = spark.read.parquet(flagged_path)
        ok = Q.passed(flagged)
        out[f"{name}_inspections"] = write_table(
            C.add_silver_lineage(C.drop_columns(ok, prefixes=["Violation"]), keys, cfg.run_ts),
            f"{s}/{name}_inspections", counts=counts)
        out[f"{name}_violations"] = write_table(
            C.add_silver_lineage(viol_fn(ok), ["Inspection_ID", "violation_code"], cfg.run_ts),
            f"{s}/{name}_violations", counts=counts)
        write_table(Q.quarantined(flagged, rules), f"{s}/{name}_quarantine", counts=counts)
        seen = spark.range(1).select(*[F.lit(n).cast("bigint").alias(m) for m, n in counts[flagged_path].items() if m != "row_count"])
        write_table(Q.audit_rows(seen, rules), f"{s}/{name}_rules_audit")
        return out

    sources = [("north", lambda b: CL.cleanse(b, V.NORTH), V.north_rules(), lambda ok: CL.violations_long(ok, V.NORTH),
                ["Inspection_ID", "DBA_Name", "Inspection_Date"]),
               ("south", V.south_clean, V.south_rules(), lambda ok: CL.violations_long(ok, V.SOUTH),
                ["Inspection_ID", "Restaurant_Name", "Inspection_Date"])]
    # the sources are independent: submit their jobs concurrently so the scheduler can
    # fill cores one source's small stages leave idle
    out: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=len(sources)) as pool:
        for part in pool.map(lambda a: one(*a), sources):
            out.update(part)
    return out


def gold(spark: SparkSession, cfg: RunConfig, counts: dict[str, dict] | None = None) -> dict[str, str]:
    """Silver -> conformed staging -> dimensions (SCD2 versioned) -> fact -> bridge."""
    s = cfg.layer("silver")
    g = cfg.layer("gold")
    insp = C.conform_union([(spark.read.parquet(f"{s}/north_inspections"), NORTH_MAP),
                            (spark.read.parquet(f"{s}/south_inspections"), SOUTH_MAP)], INSPECTION_SCHEMA)
    viol = _viol(spark.read.parquet(f"{s}/north_violations")).unionByName(
        _viol(spark.read.parquet(f"{s}/south_violations")))

    def write_dim(name: str, df: DataFrame) -> dict[str, str]:
        return {name: write_table(C.add_gold_lineage(df, cfg.job_id, cfg.run_ts), f"{g}/{name}", counts=counts)}

    def restaurant_fact_bridge() -> dict[str, str]:
        # SCD2 restaurant dimension: new version from the previous one
        out = {}
        staging = spark.read.parquet(write_table(S.staging_restaurants(insp), f"{g}/staging_restaurant"))
        # only current rows are merged and written; versions closed by earlier runs stay where they are
        prev = read_history(spark, f"{g}/dim_restaurant", current_only=True)
        nxt = SCD.scd2_merge(prev, staging, S.RESTAURANT_KEYS, S.TRACKED, cfg.as_of, cfg.run_ts, cfg.job_id,
                             nullable=S.RESTAURANT_NULLABLE, validate=True)
        write_history(spark, nxt, f"{g}/dim_restaurant")
        out["dim_restaurant"] = f"{HISTORY}{g}/dim_restaurant"
        dim_r = read_history(spark, f"{g}/dim_restaurant", current_only=True)
        # location/type/violation keys are pure functions of their natural keys (the dims
        # are built from the same silver rows), so the fact and bridge compute them in
        # place instead of joining; only the SCD2 version key needs a lookup.
        fact = ST.load_fact(insp, dim_r, lookup="hash", job_id=cfg.job_id, run_ts=cfg.run_ts, lineage=True)
        out["fact_inspection"] = write_table(fact, f"{g}/fact_inspection", counts=counts)
        bridge = ST.load_bridge(viol, spark.read.parquet(out["fact_inspection"]), lookup="hash",
                                job_id=cfg.job_id, run_ts=cfg.run_ts, lineage=True)
        out["bridge_inspection_violation"] = write_table(bridge, f"{g}/bridge_inspection_violation", counts=counts)
        return out

    # calendar, location, type and violation dimensions (unique on their natural keys) are
    # independent of the restaurant -> fact -> bridge chain: their jobs run concurrently
    tasks = [lambda: write_dim("dim_date", D.dim_date([(insp, "inspection_date")])),
             lambda: write_dim("dim_location", D.dim_location(insp)),
             lambda: write_dim("dim_inspection_type", D.dim_inspection_type(insp)),
             lambda: write_dim("dim_violation", D.dim_violation(viol)),
             restaurant_fact_bridge]
    out: dict[str, str] = {}
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        for part in pool.map(lambda t: t(), tasks):
            out.update(part)
    return out


def extracts(spark: SparkSession, cfg: RunConfig, gold_paths: dict[str, str]) -> dict[str, str]:
    """BI extracts: the denormalised fact (row-level, Parquet, fully parallel) and three
    bounded summaries (results by year, risk x facility, top violations) as small CSVs."""
    from tidewater.operators import reports as R
    from tidewater.sinks import write_csv_extract
    rd = lambda k: read_table(spark, gold_paths[k])
    fact, dim_r = rd("fact_inspection"), rd("dim_restaurant")
    out_base = f"{cfg.base_path}/extracts"
    out = {"fact_inspections_denormalized": write_table(
        R.denormalized(fact, dim_r, rd("dim_location"), rd("dim_inspection_type"), rd("dim_date")),
        f"{out_base}/fact_inspections_denormalized")}
    for name, df in (("summary_results_by_year", R.pass_rate_trend(fact)),
                     ("summary_risk_facility", R.summary_risk_facility(fact, dim_r)),
                     ("summary_top_violations", R.top_violation_codes(rd("bridge_inspection_violation"),
                                                                      rd("dim_violation"), 15))):
        # aggregates / top-k: bounded by categories, so one output file is fine
        out[name] = write_csv_extract(df, f"{out_base}/{name}", single_file=True)
    return out


def register_views(spark: SparkSession, paths: dict[str, str]) -> list[str]:
    """Expose every written table as a temp view named like the table (``dim_restaurant``
    is its current version), so existing SQL (e.g. SCD2 validation queries) runs as is."""
    from tidewater.sinks import register_view
    return [register_view(read_table(spark, p), name) for name, p in paths.items()]


def row_counts(spark: SparkSession, paths: dict[str, str], counts: dict[str, dict] | None = None) -> DataFrame:
    """(table_name, row_count) of written tables: as observed by their writes in ``counts``, else by a scan."""
    known = {n: counts[p]["row_count"] for n, p in paths.items() if counts and p in counts}
    out = None
    for name, p in paths.items():
        one = (spark.range(1).select(F.lit(known[name]).cast("bigint").alias("row_count")) if name in known
               else read_table(spark, p).agg(F.count(F.lit(1)).alias("row_count"))).select(F.lit(name).alias("table_name"), "row_count")
        out = one if out is None else out.unionByName(one)
    return out


def run(spark: SparkSession, sf_dir: str, cfg: RunConfig, counts: dict[str, dict] | None = None) -> dict[str, str]:
    """All layers; ``counts`` takes what each write observed, by path."""
    paths = {}
    paths.update({f"bronze_{k}": v for k, v in bronze(spark, sf_dir, cfg, counts).items()})
    paths.update({f"silver_{k}": v for k, v in silver(spark, cfg, counts).items()})
    paths.update(gold(spark, cfg, counts))
    return paths


def default_config(spark: SparkSession, base: str | None = None, as_of: dt.date | None = None,
                   run_ts: dt.datetime | None = None, job_id: str = "pipeline") -> RunConfig:
    """Run config; without ``base`` the tables go to a fresh folder under the shared
    checkpoint dir the session names (one folder per run, never reused)."""
    import uuid

    from tidewater.session import scratch_path
    run_ts = run_ts or dt.datetime(2001, 12, 1, 6)
    base = base or scratch_path(spark, f"lakehouse-{run_ts:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}")
    return RunConfig(base_path=base, job_id=job_id, as_of=as_of or dt.date(2001, 12, 1), run_ts=run_ts)
