"""Dimension builders. Each dimension is unique on its natural key *by construction*
(a group-by on exactly the key), so joining a fact to it can never fan out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import date_parts
from tidewater.functions.keys import hash_key


def date_bounds(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row (lo, hi): min and max date over several sources (partial aggregates, no collect)."""
    dates = None
    for df, col in frames:
        d = df.select(F.col(col).cast("date").alias("_d"))
        dates = d if dates is None else dates.unionByName(d)
    return dates.agg(F.min("_d").alias("lo"), F.max("_d").alias("hi"))


def dim_date(frames: list[tuple[DataFrame, str]]) -> DataFrame:
    """One row per calendar day from the earliest to the latest date seen.

    The day list is generated from the one-row bounds frame (its size is the calendar
    span, not the data volume). Empty inputs give an empty dimension.
    """
    bounds = date_bounds(frames)
    days = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    return days.withColumns(date_parts("full_date"))


def location_key_cols() -> list[str]:
    return ["source_city", "address", "city", "state", "zip"]


def dim_location(conformed: DataFrame) -> DataFrame:
    """Grain: (address, city, state, zip, source_city). Coordinates are taken as one real
    pair — the greatest (latitude, longitude) — rather than two independent maxima."""
    keys = ["address", "city", "state", "zip", "source_city"]
    return (conformed.groupBy(*keys)
            .agg(F.max(F.struct("latitude", "longitude")).alias("_p"))
            .select(*keys, F.col("_p.latitude").alias("latitude"), F.col("_p.longitude").alias("longitude"))
            .withColumn("location_key", hash_key([F.col(c) for c in location_key_cols()])))


def dim_inspection_type(conformed: DataFrame, col: str = "inspection_type") -> DataFrame:
    return (conformed.select(F.col(col).alias("inspection_type_name"), "source_city").distinct()
            .withColumn("inspection_type_key", hash_key(["source_city", "inspection_type_name"])))


def dim_violation(violations: DataFrame) -> DataFrame:
    """Grain: (violation_code, violation_description, source_city); points = max seen."""
    keys = ["violation_code", "violation_description", "source_city"]
    return (violations.groupBy(*keys).agg(F.max("violation_points").alias("violation_points"))
            .withColumn("violation_key", hash_key(["source_city", "violation_code", "violation_description"])))


def duplicate_keys(df: DataFrame, keys: list[str | Column]) -> DataFrame:
    """Keys that occur more than once (empty frame = the key is unique)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
            .filter(F.col("row_count") > 1))


def assert_unique(df: DataFrame, keys: list[str | Column], what: str = "dimension") -> None:
    """Action: raise if ``keys`` is not unique in ``df`` (guards joins against fan-out)."""
    bad = duplicate_keys(df, keys).limit(1).collect()
    if bad:
        raise ValueError(f"{what} is not unique on {keys}: e.g. {bad[0].asDict()}")
