"""As-of lookup: each fact row takes the version of its key that was valid on its date.

No range join: dates are cut into slices of a fixed number of days, and facts meet versions on
(key, slice). What a fact of that key and slice can match is one row: the versions that start
in the slice, and the one that was valid when the slice began, carried over from the slices
before. A key's versions do not overlap, so that row holds at most one version for each day of the slice; and as facts are
dealt by (key, slice), a key that holds a third of all facts is spread over its slices. Slices are about a year long: in
short ones most facts are alone in theirs, and there are as many (key, slice) rows to find as facts.

Facts are read three times, each time the columns that are needed alone: for the slices to find, for the join, and for
those with a NULL in the key or date, which match nothing and are not dealt. They should be stored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def as_of_lookup(facts: DataFrame, versions: DataFrame, keys: list[tuple[Column, Column]], date: str, payload: list[str],
                 start: str = "effective_start_date", end: str = "effective_end_date", current: str = "is_current",
                 backdate: bool = False, slice_days: int = 366) -> DataFrame:
    """``facts`` with the ``payload`` columns of the version valid on ``date``, NULL where there is none.

    ``keys`` pairs an expression over the facts with one over the versions; a NULL key matches
    nothing. A version is valid from ``start`` until the day before ``end`` (the day of a change
    belongs to the newer version), a current one without end; versions that begin and end on one
    day are never valid. With ``backdate`` a key's first version is valid before its start, too.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    taken = set(facts.columns)
    if clash := taken & {*payload, *names, "_slice", "_lead", "_version", "_versions"}:
        raise ValueError(f"facts already have the columns {sorted(clash)}")

    def slice_of(day: Column) -> Column:
        return F.floor(F.unix_date(day.cast("date")) / slice_days).cast("int")
    named = facts.select("*", *[k.alias(n) for (k, _), n in zip(keys, names)])
    unknown = reduce(lambda a, b: a | b, [F.col(n).isNull() for n in names] + [F.col(date).isNull()])
    left = named.where(~unknown).withColumn("_slice", slice_of(F.col(date)))

    until = F.when(F.col(current), F.lit(None)).otherwise(F.col(end)).cast("date")
    version = F.struct(F.col(start).cast("date").alias("_from"), until.alias("_until"), *payload)
    own = (versions.where(F.col(start).isNotNull() & (F.col(current) | (F.col(start) < F.col(end))))
           .select(*[v.alias(n) for (_, v), n in zip(keys, names)], slice_of(F.col(start)).alias("_slice"), version.alias("_version"))
           .dropna(subset=names)
           .groupBy(*names, "_slice").agg(F.sort_array(F.collect_list("_version")).alias("own")))
    # one row for each (key, slice) that has facts, one for each that has new versions: no more than a key has slices
    asked = left.select(*names, "_slice").distinct()
    marks = (own.select(*names, "_slice", F.lit(False).alias("asked"), "own")
             .union(asked.select(*names, "_slice", F.lit(True).alias("asked"), F.lit(None).cast(own.schema["own"].dataType).alias("own"))))
    # a number in front of the key: rows are sorted by their first column's first eight bytes, which many names share
    key = Window.partitionBy(F.hash(*names), *names).orderBy("_slice")
    before, here = key.rangeBetween(Window.unboundedPreceding, -1), key.rangeBetween(0, 0)
    carried = F.last(F.element_at("own", -1), ignorenulls=True).over(before)
    none = F.array().cast(own.schema["own"].dataType)
    if backdate:
        first = F.first(F.get("own", F.lit(0)), ignorenulls=True).over(key.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        carried = F.coalesce(carried, first.withField("_from", F.lit("0001-01-01").cast("date")))
    found = marks.withColumns({"carried": carried, "own": F.last("own", ignorenulls=True).over(here)})
    known = (found.where("asked")
             .select(*names, "_slice", F.concat(F.when(F.col("carried").isNotNull(), F.array("carried")).otherwise(none),
                                                F.coalesce("own", none)).alias("_versions"))
             .where(F.size("_versions") > 0))
    begun = F.filter("_versions", lambda v: v["_from"] <= F.col(date).cast("date"))
    last = F.try_element_at(begun, F.lit(-1))
    lead = F.hash(*names, "_slice")
    joined = left.withColumn("_lead", lead).join(known.withColumn("_lead", lead), ["_lead", *names, "_slice"], "left").withColumn("_version", last)
    valid = F.col("_version._until").isNull() | (F.col(date).cast("date") < F.col("_version._until"))
    dated = joined.select(*[f"`{c}`" for c in facts.columns], *[F.when(valid, F.col(f"_version.{p}")).alias(p) for p in payload])
    return dated.union(named.where(unknown).select(*[f"`{c}`" for c in facts.columns], *[F.lit(None).cast(dated.schema[p].dataType).alias(p) for p in payload]))
