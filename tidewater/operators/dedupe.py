"""Keep-one-per-key operators with a deterministic survivor.

The default plan is an aggregate (``max``/``min`` of a struct whose leading fields are
the ordering columns). Aggregates are combined map-side, so a key holding a third of
all rows is reduced to one row per input partition *before* the shuffle; no single
task ever sorts or holds a hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str], descending: bool = True) -> DataFrame:
    """One row per key: the one with the greatest (or least) ``order`` tuple.

    Remaining columns break ties, so the survivor is a total-order choice and identical
    for any partitioning. NULL ordering values rank lowest (like ``desc_nulls_last``).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    payload = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                       *[F.col(c) for c in rest])
    pick = F.max(payload) if descending else F.min(payload)
    out = df.groupBy(*keys).agg(pick.alias("_best"))
    return out.select(*keys, *[F.col(f"_best._o{i}").alias(c) for i, c in enumerate(order)],
                      *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def latest_per_key_window(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """``row_number() = 1`` formulation for mixed sort directions.

    Spark inserts a partial WindowGroupLimit before the shuffle, so hot keys are cut to
    one row per map partition here too. ``order`` holds Columns (e.g. F.desc("d")).
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def dedupe(df: DataFrame, keys: list[str]) -> DataFrame:
    """``dropDuplicates(keys)`` with a deterministic survivor (smallest remaining tuple)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    out = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_best"))
    return out.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)
