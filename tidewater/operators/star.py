"""Fact and bridge loads with fan-out-safe dimension lookups.

Dimension lookups are LEFT joins on the full natural key with null-safe equality, against
dimensions that are unique on that key by construction (``operators.dims``), so a fact
row can never be duplicated. Join strategy is left to Catalyst/AQE: a dimension under
``spark.sql.autoBroadcastJoinThreshold`` (a size check on the actual data) is broadcast,
a larger one is shuffle-joined, skewed partitions are split by AQE.

``lookup="hash"`` skips the location/type joins entirely: their keys are a pure function
of the natural key (``functions.keys.hash_key``), so the fact computes them in place and
is shuffled once (for the SCD2 restaurant lookup) instead of three times.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.config import DEFAULT_JOB_ID
from tidewater.functions.dates import date_key
from tidewater.functions.keys import hash_key
from tidewater.operators.asof import as_of_lookup
from tidewater.operators.columns import add_gold_lineage
from tidewater.operators.dims import assert_unique, location_key_cols

FACT_COLS = ["inspection_id", "restaurant_key", "location_key", "inspection_type_key", "date_key",
             "inspection_result", "inspection_score", "source_city", "inspection_key"]


def _null_safe_join(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    cond = reduce(lambda a, b: a & b, [left[lc].eqNullSafe(right[rc]) for lc, rc in pairs])
    return left.join(right, cond, "left")


def inspection_key() -> F.Column:
    return hash_key(["source_city", "inspection_id"])


def _with_current(inspections: DataFrame, dim_restaurant: DataFrame, validate: bool) -> DataFrame:
    cur = dim_restaurant.filter(F.col("is_current")).select(
        F.col("restaurant_name").alias("_r_name"), F.col("source_city").alias("_r_city"),
        F.coalesce(F.col("license_number"), F.lit("")).alias("_r_lic"), "restaurant_key")
    if validate:
        assert_unique(cur, ["_r_name", "_r_city", "_r_lic"], "current dim_restaurant")
    f = inspections.withColumn("_lic", F.coalesce(F.col("license_number"), F.lit("")))
    return f.join(cur, (f["restaurant_name"] == cur["_r_name"]) & (f["source_city"] == cur["_r_city"])
                  & (f["_lic"] == cur["_r_lic"]), "left")


def _with_versions(inspections: DataFrame, dim_restaurant: DataFrame) -> DataFrame:
    same = [F.col("restaurant_name"), F.col("source_city"), F.coalesce(F.col("license_number"), F.lit(""))]
    return as_of_lookup(inspections, dim_restaurant, [(c, c) for c in same], "inspection_date", ["restaurant_key"], backdate=True)


def load_fact(inspections: DataFrame, dim_restaurant: DataFrame, dim_location: DataFrame | None = None,
              dim_type: DataFrame | None = None, lookup: str = "join", validate: bool = False,
              job_id: str = DEFAULT_JOB_ID, run_ts: dt.datetime | None = None,
              lineage: bool = False, as_of_date: bool = False) -> DataFrame:
    """One fact row per inspection.

    ``inspections`` columns: inspection_id, restaurant_name, license_number, source_city,
    address, city, state, zip, inspection_type, inspection_date, inspection_result,
    inspection_score. ``dim_restaurant`` is filtered to current rows here (pushed into
    the Parquet scan). Restaurant match: name, source_city, COALESCE(license,''). With
    ``as_of_date`` an inspection gets the version of its own date instead; inspections from
    before a restaurant's first version get that one.
    """
    f = _with_versions(inspections, dim_restaurant) if as_of_date else _with_current(inspections, dim_restaurant, validate)

    if lookup == "hash":
        f = f.withColumns({
            "location_key": hash_key([F.col(c) for c in location_key_cols()]),
            "inspection_type_key": hash_key(["source_city", "inspection_type"]),
        })
    else:
        loc = dim_location.select(*[F.col(c).alias("_l_" + c) for c in location_key_cols()], "location_key")
        typ = dim_type.select(F.col("inspection_type_name").alias("_t_name"),
                              F.col("source_city").alias("_t_city"), "inspection_type_key")
        if validate:
            assert_unique(loc, ["_l_" + c for c in location_key_cols()], "dim_location")
            assert_unique(typ, ["_t_name", "_t_city"], "dim_inspection_type")
        f = _null_safe_join(f, loc, [(c, "_l_" + c) for c in location_key_cols()])
        f = _null_safe_join(f, typ, [("inspection_type", "_t_name"), ("source_city", "_t_city")])

    out = f.select(
        "inspection_id", "restaurant_key", "location_key", "inspection_type_key",
        # dim_date spans every inspection date, so its key is the date itself (yyyymmdd)
        date_key("inspection_date").alias("date_key"),
        "inspection_result", "inspection_score", "source_city",
        inspection_key().alias("inspection_key"))
    return add_gold_lineage(out, job_id, run_ts) if lineage else out


def load_bridge(violations: DataFrame, fact: DataFrame, dim_violation: DataFrame | None = None,
                lookup: str = "join", job_id: str = DEFAULT_JOB_ID, run_ts: dt.datetime | None = None,
                lineage: bool = False, keep: list[str] = ()) -> DataFrame:
    """One bridge row per violation of an inspection present in the fact.

    Inspection match: (inspection_id, source_city), inner. Violation match: code,
    description, source_city — null-safe, so a missing code does not collapse entries.
    ``keep`` names more columns of the violations to carry along.
    """
    # the key follows from the violation's own columns, so one semi join on it keeps the
    # violations of loaded inspections and can never multiply them. Keys cross its shuffle as
    # 16 bytes; as only different ones matter, Catalyst drops the lookups behind the fact's.
    loaded = fact.select(F.unhex("inspection_key").alias("_key")).distinct()
    b = (violations.where(F.col("inspection_id").isNotNull() & F.col("source_city").isNotNull())
         .withColumn("_key", F.unhex(inspection_key()))
         .join(loaded, "_key", "left_semi").withColumn("inspection_key", F.lower(F.hex("_key"))))
    if lookup == "hash":
        b = b.withColumn("violation_key",
                         hash_key(["source_city", "violation_code", "violation_description"]))
    else:
        dv = dim_violation.select(F.col("violation_code").alias("_v_code"),
                                  F.col("violation_description").alias("_v_desc"),
                                  F.col("source_city").alias("_v_city"), "violation_key")
        cond = (b["violation_code"].eqNullSafe(dv["_v_code"])
                & b["violation_description"].eqNullSafe(dv["_v_desc"])
                & (b["source_city"] == dv["_v_city"]))
        b = b.join(dv, cond, "inner")
    out = b.select("inspection_key", "violation_key", "violation_comments", *keep)
    return add_gold_lineage(out, job_id, run_ts) if lineage else out


def orphan_keys(fact: DataFrame, key: str, dim: DataFrame, dim_key: str | None = None) -> DataFrame:
    """Fact rows whose foreign key does not resolve (NULL or missing in the dimension)."""
    dk = dim.select(F.col(dim_key or key).alias("_dk"))
    return fact.join(dk, fact[key] == dk["_dk"], "left_anti")
