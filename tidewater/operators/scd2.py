"""Slowly changing dimension (type 2) without a transactional table format.

``scd2_merge`` is a pure function (dimension, staging, as_of) -> next dimension; the
caller writes the result as a new version (``sinks.write_version``) and moves the
pointer. Plan: history rows pass through untouched; current rows are full-outer joined
with staging on the business key (one shuffle), and each joined row emits up to two
versions through an array + inline (no second pass, no self-union of the join).
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewater.config import DEFAULT_JOB_ID
from tidewater.functions.dates import END_OF_TIME, end_of_time
from tidewater.functions.keys import hash_key
from tidewater.operators.dims import duplicate_keys

SCD_COLS = ["effective_start_date", "effective_end_date", "is_current"]
LINEAGE_COLS = ["created_at", "updated_at", "etl_job_id"]


def business_key(keys: list[str], nullable: list[str], prefix: str = "") -> list[Column]:
    """Key expressions; nullable parts compare with NULL == '' (COALESCE to '')."""
    return [F.coalesce(F.col(prefix + k), F.lit("")) if k in nullable else F.col(prefix + k) for k in keys]


def _ts(run_ts):
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def initial_load(staging: DataFrame, keys: list[str], tracked: list[str], as_of: dt.date,
                 run_ts: dt.datetime | None = None, job_id: str = DEFAULT_JOB_ID,
                 key_col: str = "restaurant_key", nullable: list[str] = ()) -> DataFrame:
    """Every staging row becomes a current version starting ``as_of``."""
    ts = _ts(run_ts)
    return staging.select(
        *staging.columns,
        hash_key([*business_key(keys, list(nullable)), *[F.col(t) for t in tracked],
                  F.lit(as_of).cast("date"), F.lit(job_id), F.lit(None).cast("string")]).alias(key_col),
        F.lit(as_of).cast("date").alias("effective_start_date"),
        end_of_time().alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        ts.alias("created_at"), ts.alias("updated_at"), F.lit(job_id).alias("etl_job_id"))


def scd2_merge(dim: DataFrame | None, staging: DataFrame, keys: list[str], tracked: list[str],
               as_of: dt.date, run_ts: dt.datetime | None = None, job_id: str = DEFAULT_JOB_ID,
               key_col: str = "restaurant_key", nullable: list[str] = (),
               validate: bool = True) -> DataFrame:
    """Next version of a type-2 dimension.

    * absent ``dim`` -> initial load;
    * current row whose tracked attributes differ (NULL and '' are equal) -> closed with
      end = ``as_of``, is_current = false, updated_at = run_ts (created_at/job untouched),
      and a new current version from staging starting ``as_of``;
    * staging key without a current row -> new current version;
    * current rows whose key is missing from staging stay current; identical data is a no-op.

    ``validate`` raises if staging is not unique on the business key (an action).
    """
    nullable = list(nullable)
    if validate:
        bad = duplicate_keys(staging, business_key(keys, nullable)).limit(1).collect()
        if bad:
            raise ValueError(f"staging has duplicate business keys, e.g. {bad[0].asDict()}")
    if dim is None:
        return initial_load(staging, keys, tracked, as_of, run_ts, job_id, key_col, nullable)

    ts = _ts(run_ts)
    out_cols = dim.columns
    types = {f.name: f.dataType for f in dim.schema.fields}
    history = dim.filter(~F.col("is_current"))
    cur = dim.filter(F.col("is_current")).select(*[F.col(c).alias("t_" + c) for c in out_cols],
                                                 F.lit(True).alias("t__present"))
    stg = staging.select(*[F.col(c).alias("s_" + c) for c in staging.columns], F.lit(True).alias("s__present"))

    cond = reduce(lambda a, b: a & b, [
        tk == sk for tk, sk in zip(business_key(keys, nullable, "t_"), business_key(keys, nullable, "s_"))])
    j = cur.join(stg, cond, "full_outer")

    t_present = F.col("t__present").isNotNull()
    s_present = F.col("s__present").isNotNull()
    changed = reduce(lambda a, b: a | b, [
        F.coalesce(F.col("t_" + a), F.lit("")) != F.coalesce(F.col("s_" + a), F.lit("")) for a in tracked])
    is_change = t_present & s_present & changed

    def old_version() -> Column:
        fields = []
        for c in out_cols:
            v = F.col("t_" + c)
            if c == "effective_end_date":
                v = F.when(is_change, F.lit(as_of).cast("date")).otherwise(v)
            elif c == "is_current":
                v = F.when(is_change, F.lit(False)).otherwise(v)
            elif c == "updated_at":
                v = F.when(is_change, ts).otherwise(v)
            fields.append(v.cast(types[c]).alias(c))
        return F.struct(*fields)

    def new_version() -> Column:
        # the key of the version it replaces is part of a version's key, so a value that comes
        # back on the same day under the same job gets a key of its own
        new_key = hash_key([*business_key(keys, nullable, "s_"), *[F.col("s_" + t) for t in tracked],
                            F.lit(as_of).cast("date"), F.lit(job_id), F.col("t_" + key_col)])
        special = {
            key_col: new_key,
            "effective_start_date": F.lit(as_of).cast("date"),
            "effective_end_date": end_of_time(),
            "is_current": F.lit(True),
            "created_at": ts, "updated_at": ts, "etl_job_id": F.lit(job_id),
        }
        return F.struct(*[(special[c] if c in special else F.col("s_" + c)).cast(types[c]).alias(c)
                          for c in out_cols])

    versions = F.array(F.when(t_present, old_version()),
                       F.when(s_present & (~t_present | changed), new_version()))
    merged = j.select(F.inline(F.filter(versions, lambda x: x.isNotNull())))
    return history.unionByName(merged)


def scd2_from_snapshots(snapshots: DataFrame, keys: list[str], tracked: list[str], dim: DataFrame | None = None,
                        as_of: str = "as_of", run_ts: str = "run_ts", job_id: str = "job_id",
                        key_col: str = "restaurant_key", nullable: list[str] = ()) -> DataFrame:
    """The dimension after merging many dated snapshots, in one pass over all of them.

    ``snapshots`` holds the rows of every snapshot with the columns ``as_of``, ``run_ts`` and
    ``job_id`` of the merge that would load it; each snapshot has a business key at most once.
    The result is that of :func:`scd2_merge` over the snapshots one after the other (by as_of, then
    run_ts), starting from ``dim``: a key that is missing from a snapshot stays current, one that
    comes back with the same values does not change, and rows with a NULL in a part of the key
    that is not ``nullable`` match nothing.

    Gaps and islands: a key's rows are put in order, those that differ from the one before start
    a version, which ends as the next one starts. That is one shuffle of the rows, and a key has
    no more of them than there are snapshots. Version keys chain from one version to the next.
    """
    nullable = list(nullable)
    values = [c for c in snapshots.columns if c not in (as_of, run_ts, job_id)]
    seen = [f"_bk{i}" for i in range(len(keys))]
    loose = reduce(lambda a, b: a | b, [k.isNull() for k in business_key(keys, nullable)])
    none = F.lit(None)
    rows = snapshots.select(
        *[F.col(c) for c in values], *[k.alias(n) for k, n in zip(business_key(keys, nullable), seen)],
        # a row that matches nothing is a key of its own in each snapshot
        F.when(loose, F.struct(F.col(as_of).cast("date").alias("day"), F.col(run_ts).cast("timestamp").alias("ts"),
                               F.xxhash64(*[f"`{c}`" for c in values]).alias("row"))).alias("_own"),
        F.lit(False).alias("_loaded"), F.col(as_of).cast("date").alias("_day"), F.col(run_ts).cast("timestamp").alias("_ts"),
        F.col(job_id).cast("string").alias("_job"), none.cast("string").alias("_key"), none.cast("timestamp").alias("_created"),
        none.cast("timestamp").alias("_updated"))
    if dim is not None:
        live = dim.where("is_current").withColumn("_loose", loose)
        rows = rows.unionByName(live.where(~F.col("_loose")).select(
            *values, *[k.alias(n) for k, n in zip(business_key(keys, nullable), seen)], none.cast(rows.schema["_own"].dataType).alias("_own"),
            F.lit(True).alias("_loaded"), F.col("effective_start_date").alias("_day"), none.cast("timestamp").alias("_ts"),
            F.col("etl_job_id").alias("_job"), F.col(key_col).alias("_key"), F.col("created_at").alias("_created"), F.col("updated_at").alias("_updated")))
    group = [*seen, "_own"]
    # the loaded version comes first whatever its dates are
    order = Window.partitionBy(*group).orderBy(F.desc("_loaded"), "_day", "_ts")

    def plain(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit(""))
    changed = reduce(lambda a, b: a | b, [plain(t) != F.lag(plain(t)).over(order) for t in tracked])
    starts = (rows.withColumn("_new", F.coalesce(changed, F.lit(True))).where("_new")
              .withColumns({"_end": F.lead("_day").over(order), "_closed": F.lead("_ts").over(order),
                            "_n": F.row_number().over(order)}))
    version = F.struct("_n", *values, *seen, "_loaded", "_day", "_ts", "_job", "_key", "_created", "_updated", "_end", "_closed")
    chains = starts.groupBy(*group).agg(F.sort_array(F.collect_list(version)).alias("_v"))

    def next_key(done: Column, v: Column) -> Column:
        made = hash_key([*[v[n] for n in seen], *[v[t] for t in tracked], v["_day"], v["_job"], F.get(done, F.size(done) - 1)])
        return F.concat(done, F.array(F.when(v["_loaded"], v["_key"]).otherwise(made)))
    # a key's versions are few (no more than snapshots), so the keys are chained in its row
    keyed = chains.select("_v", F.aggregate("_v", F.array().cast("array<string>"), next_key).alias("_keys"))
    v = F.col("_x._v")
    current = v["_end"].isNull()
    out = keyed.select(F.explode(F.arrays_zip("_v", "_keys")).alias("_x")).select(
        *[v[c].alias(c) for c in values], F.col("_x._keys").alias(key_col),
        v["_day"].alias("effective_start_date"), F.coalesce(v["_end"], end_of_time()).alias("effective_end_date"), current.alias("is_current"),
        F.when(v["_loaded"], v["_created"]).otherwise(v["_ts"]).alias("created_at"),
        F.coalesce(v["_closed"], F.when(v["_loaded"], v["_updated"]).otherwise(v["_ts"])).alias("updated_at"), v["_job"].alias("etl_job_id"))
    if dim is None:
        return out
    types = {f.name: f.dataType for f in dim.schema.fields}
    out = out.select(*[F.col(c).cast(types[c]).alias(c) for c in dim.columns])
    return dim.where(~F.col("is_current")).unionByName(live.where("_loose").drop("_loose")).unionByName(out)


# ---- validation queries over a type-2 dimension ----------------------------------------

def scd2_state(dim: DataFrame) -> DataFrame:
    """Rows per is_current flag (current first)."""
    return dim.groupBy("is_current").agg(F.count(F.lit(1)).alias("row_count")).orderBy(F.desc("is_current"))


def scd2_totals(dim: DataFrame) -> DataFrame:
    """One row: total, current and expired versions (one aggregate)."""
    return dim.agg(F.count(F.lit(1)).alias("total_rows"),
                   F.count_if(F.col("is_current")).alias("current_rows"),
                   F.count_if(~F.col("is_current")).alias("expired_rows"))


def scd2_history(dim: DataFrame, keys: list[str], nullable: list[str] = ()) -> DataFrame:
    """All versions of business keys that have more than one version.

    Keys-with-history is a map-side-combined count, then a semi join (no window over a
    possibly huge key group).
    """
    nullable = list(nullable)
    bk = business_key(keys, nullable)
    names = [f"_bk{i}" for i in range(len(keys))]
    multi = (dim.groupBy(*[e.alias(n) for e, n in zip(bk, names)])
             .agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n"))
    d = dim.select("*", *[e.alias(n) for e, n in zip(bk, names)])
    return d.join(multi, names, "left_semi").drop(*names)


def scd2_change_detail(dim: DataFrame, keys: list[str], tracked: list[str], nullable: list[str] = (),
                       key_col: str = "restaurant_key") -> DataFrame:
    """Old -> new values of the latest two versions per business key (keys with history only).

    ``row_number() <= 2`` lets Spark apply a partial WindowGroupLimit before the shuffle;
    ties on the start date are broken by is_current, end date and key.
    """
    nullable = list(nullable)
    bk = business_key(keys, nullable)
    names = [f"_bk{i}" for i in range(len(keys))]
    d = dim.select("*", *[e.alias(n) for e, n in zip(bk, names)])
    w = Window.partitionBy(*names).orderBy(F.desc("effective_start_date"), F.desc("is_current"),
                                           F.desc("effective_end_date"), F.desc(key_col))
    top2 = d.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= 2)
    payload = F.struct(*keys, *tracked, "effective_start_date", "effective_end_date")
    pairs = (top2.groupBy(*names)
             .agg(F.max(F.when(F.col("_rn") == 1, payload)).alias("n"),
                  F.max(F.when(F.col("_rn") == 2, payload)).alias("o"))
             .filter(F.col("o").isNotNull()))
    cols = [F.col(f"n.{k}").alias(k) for k in keys]
    for a in tracked:
        cols += [F.col(f"o.{a}").alias(f"old_{a}"), F.col(f"n.{a}").alias(f"new_{a}")]
    cols += [F.col("o.effective_start_date").alias("old_start"), F.col("o.effective_end_date").alias("old_end"),
             F.col("n.effective_start_date").alias("new_start"), F.col("n.effective_end_date").alias("new_end")]
    return pairs.select(*cols)


def scd2_checks(dim: DataFrame, keys: list[str], nullable: list[str] = ()) -> DataFrame:
    """Integrity checks (check_name, failures, passed) in one pass over the dimension:
    keys with more than one current row, keys with no current row, expired rows still
    open-ended, current rows not open-ended."""
    nullable = list(nullable)
    bk = business_key(keys, nullable)
    open_end = F.col("effective_end_date") == F.lit(END_OF_TIME).cast("date")
    per_key = dim.groupBy(*bk).agg(
        F.count_if(F.col("is_current")).alias("n_current"),
        F.count_if(~F.col("is_current") & open_end).alias("bad_expired"),
        F.count_if(F.col("is_current") & ~open_end).alias("bad_current"))
    one = per_key.agg(
        F.count_if(F.col("n_current") > 1).alias("c1"),
        F.count_if(F.col("n_current") == 0).alias("c2"),
        F.coalesce(F.sum("bad_expired"), F.lit(0)).alias("c3"),
        F.coalesce(F.sum("bad_current"), F.lit(0)).alias("c4"))
    names = ["multiple_current_rows", "no_current_row", "expired_with_open_end", "current_not_open_end"]
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"c{i + 1}").cast("long").alias("failures"))
                     for i, n in enumerate(names)])
    return one.select(F.inline(rows)).withColumn("passed", F.col("failures") == 0)


def scd2_compare_totals(before: DataFrame, after: DataFrame) -> DataFrame:
    """No-change check: totals before and after a re-run, and whether they are equal."""
    both = (before.select(F.lit(True).alias("_before"), "is_current")
            .unionByName(after.select(F.lit(False).alias("_before"), "is_current")))
    b, cur = F.col("_before"), F.col("is_current")
    return both.agg(F.count_if(b).alias("total_rows_before"), F.count_if(b & cur).alias("current_rows_before"),
                    F.count_if(~b).alias("total_rows_after"), F.count_if(~b & cur).alias("current_rows_after")
                    ).withColumn(
        "unchanged", (F.col("total_rows_before") == F.col("total_rows_after"))
        & (F.col("current_rows_before") == F.col("current_rows_after")))


def as_of(dim: DataFrame, day: dt.date) -> DataFrame:
    """Versions valid on ``day``; end dates are inclusive of the change day, so the day
    of a change resolves to the newer version."""
    d = F.lit(day).cast("date")
    return dim.filter((F.col("effective_start_date") <= d)
                      & ((d < F.col("effective_end_date")) | F.col("is_current")))
