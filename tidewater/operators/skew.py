"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARE = 1 / 1000   # keys above this share of all rows are hot, so there are never more than 1,000 of them


def null_safe(left: list[str], right: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


def join_counted(rows: DataFrame, keyed: DataFrame, on: list[str], count: str, value: str, share: float = SHARE) -> DataFrame:
    """``rows`` with the ``value`` of their key in ``keyed``, NULL if it is not there; NULL keys are equal.

    ``keyed`` has each key once and says in ``count`` how many rows have it. Keys with more than
    ``share`` of all counted rows are at most 1 / share: they are broadcast, and their rows go through
    the second join spread by a hash of the whole row, where they match nothing. The others are
    joined by a shuffle in which no key has more than that share. ``keyed`` is read three times:
    store it if it is costly.
    """
    names = [f"_on{i}" for i in range(len(on))]
    limit = keyed.agg(F.coalesce(F.sum(count), F.lit(0)) * share).scalar()
    hot = keyed.where(F.col(count) > limit).select(*[F.col(c).alias("_h" + n) for c, n in zip(on, names)], F.col(value).alias("_hot"), F.lit(True).alias("_is_hot"))
    rest = keyed.where(F.col(count) <= limit).select(*[F.col(c).alias("_c" + n) for c, n in zip(on, names)], F.col(value).alias("_cold"), F.lit(0).alias("_c_salt"))
    first = rows.join(F.broadcast(hot), null_safe(on, ["_h" + n for n in names]), "left")
    salt = F.when(F.col("_is_hot"), 1 + F.pmod(F.xxhash64(*[f"`{c}`" for c in rows.columns]), F.lit(1 << 20)).cast("int")).otherwise(0)
    both = first.withColumn("_salt", salt).join(rest, null_safe([*on, "_salt"], [*["_c" + n for n in names], "_c_salt"]), "left")
    return both.select(*[F.col(f"`{c}`") for c in rows.columns], F.coalesce("_hot", "_cold").alias(value))
