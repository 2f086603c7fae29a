"""Projection-level operators: renames, lineage, conformance, overlays."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from tidewater.config import DEFAULT_JOB_ID, SourceMapping
from tidewater.functions.keys import durability_key


def sanitize_name(name: str) -> str:
    """The runs of ASCII letters and digits in ``name``, joined by '_'."""
    return "_".join(re.findall("[A-Za-z0-9]+", name))


def sanitize_columns(df: DataFrame, on_collision: str = "raise") -> DataFrame:
    """Rename every column in one projection; two names mapping to one raise (or get a suffix)."""
    seen: dict[str, int] = {}
    out = []
    for old in df.columns:
        new = sanitize_name(old) or "col"
        if new in seen:
            if on_collision == "raise":
                raise ValueError(f"column name collision after sanitising: {old!r} -> {new!r}")
            seen[new] += 1
            new = f"{new}_{seen[new]}"
        else:
            seen[new] = 0
        out.append(new)
    return df.toDF(*out)


def _ts(run_ts: dt.datetime | None) -> Column:
    return F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")


def add_bronze_lineage(df: DataFrame, source_name: str, job_id: str = DEFAULT_JOB_ID,
                       run_ts: dt.datetime | None = None) -> DataFrame:
    return df.withColumns({
        "data_source_name": F.lit(source_name),
        "ingest_timestamp": _ts(run_ts),
        "etl_job_id": F.lit(job_id),
    })


def add_silver_lineage(df: DataFrame, key_columns: list[str], run_ts: dt.datetime | None = None) -> DataFrame:
    return df.withColumns({
        "updated_at": _ts(run_ts),
        "durability_key": durability_key(key_columns),
    })


def add_gold_lineage(df: DataFrame, job_id: str = DEFAULT_JOB_ID, run_ts: dt.datetime | None = None) -> DataFrame:
    ts = _ts(run_ts)
    return df.withColumns({"created_at": ts, "updated_at": ts, "etl_job_id": F.lit(job_id)})


def drop_columns(df: DataFrame, prefixes: Iterable[str] = (), names: Iterable[str] = ()) -> DataFrame:
    """Drop columns by prefix and by name; names that do not exist are ignored."""
    prefixes = tuple(prefixes)
    doomed = [c for c in df.columns if (prefixes and c.startswith(prefixes)) or c in set(names)]
    return df.drop(*doomed)


def conform(df: DataFrame, mapping: SourceMapping, target: list[tuple[str, DataType]]) -> DataFrame:
    """Project one source onto the target schema: rename, cast, typed NULL, constants."""
    cols = []
    for name, dtype in target:
        if name in mapping.constants:
            cols.append(F.lit(mapping.constants[name]).cast(dtype).alias(name))
        elif mapping.columns.get(name) is not None:
            cols.append(F.col(mapping.columns[name]).cast(dtype).alias(name))
        else:
            cols.append(F.lit(None).cast(dtype).alias(name))
    return df.select(*cols)


def conform_union(sources: list[tuple[DataFrame, SourceMapping]], target: list[tuple[str, DataType]]) -> DataFrame:
    """Conform each source and union them by name (no shuffle)."""
    parts = [conform(df, m, target) for df, m in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def overlay(df: DataFrame, key_col: str, keys: list, updates: dict[str, object]) -> DataFrame:
    """Set columns to new values on rows whose key (compared as text) is in ``keys``."""
    hit = F.col(key_col).cast("string").isin([str(k) for k in keys])
    return df.withColumns({c: F.when(hit, F.lit(v)).otherwise(F.col(c)) for c, v in updates.items()})


def overlay_by_frame(df: DataFrame, picks: DataFrame, key_cols: list[str], updates: dict[str, Column],
                     broadcast_picks: bool = False) -> DataFrame:
    """Conditional update driven by a frame of picked keys (no driver collect, no cap).

    ``picks`` holds the key columns plus any columns the ``updates`` expressions read
    (e.g. a pick number) and must be unique on the keys. Set ``broadcast_picks`` only when
    the caller has a proven bound on its size (e.g. it comes from a ``limit(n)`` pick);
    otherwise the planner decides from the measured size. Rows without a pick keep their
    values.
    """
    hit_cols = [c for c in picks.columns if c not in key_cols]
    small = picks.select(*[F.col(k).alias(f"_p_{k}") for k in key_cols], *hit_cols, F.lit(True).alias("_picked"))
    cond = None
    for k in key_cols:
        c = df[k].eqNullSafe(small[f"_p_{k}"])
        cond = c if cond is None else cond & c
    j = df.join(F.broadcast(small) if broadcast_picks else small, cond, "left")
    hit = F.col("_picked").isNotNull()
    out = j.withColumns({c: F.when(hit, e).otherwise(F.col(c)) for c, e in updates.items()})
    return out.select(*df.columns)


def with_overrides(df: DataFrame, overrides: dict[str, object]) -> DataFrame:
    """Same rows with some columns replaced by literals, keeping each column's type."""
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.withColumns({c: F.lit(v).cast(types.get(c, StringType())) for c, v in overrides.items()})
