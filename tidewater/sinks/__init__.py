"""Writers: full-refresh tables, dated snapshots, versioned tables, small CSV extracts."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewater.sources.tables import POINTER, current_version, table_exists


def register_view(df: DataFrame, name: str) -> str:
    """Expose a frame to SQL callers as a session temp view (no data is copied)."""
    df.createOrReplaceTempView(name)
    return name


def ensure_namespace(spark: SparkSession, name: str, use: bool = False) -> str:
    """``CREATE DATABASE IF NOT EXISTS`` (and optionally ``USE``) a layer namespace."""
    if not name.replace("_", "").isalnum():
        raise ValueError(f"invalid namespace {name!r}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    if use:
        spark.sql(f"USE {name}")
    return name


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                fmt: str = "parquet", counts: dict[str, dict] | None = None, metrics: dict[str, Column] | None = None) -> str:
    """Full refresh (or append) of a Parquet table at ``path``.

    A refresh replaces every partition, whatever the session's overwrite mode is. With ``counts``
    the number of rows written (``row_count``) and the aggregates of ``metrics`` are taken while the
    rows pass, with no second scan, and put into ``counts[path]``; a task that is run again counts once.
    """
    observed = Observation() if counts is not None else None
    if observed is not None:
        df = df.observe(observed, F.count(F.lit(1)).alias("row_count"), *[m.alias(n) for n, m in (metrics or {}).items()])
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "static")
    if fmt == "parquet":
        w = w.option("compression", "zstd")  # hex keys take half the room they do under snappy
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    if observed is not None:
        counts[path] = dict(observed.get)
    return path


def save_as_table(df: DataFrame, name: str, mode: str = "overwrite", fmt: str = "parquet") -> str:
    df.write.mode(mode).format(fmt).saveAsTable(name)
    return name


def load_mode(spark: SparkSession, name: str, provider: str = "parquet") -> str:
    """How a dimension table is to be loaded: ``first_load`` if there is none, else ``merge``.

    A table of that name in another format cannot be merged into: it is dropped, and the load
    is a first one.
    """
    if not table_exists(spark, name):
        return "first_load"
    if table_exists(spark, name, provider):
        return "merge"
    spark.sql(f"DROP TABLE {name}")
    return "first_load"


def snapshot_path(base: str, table: str, run_ts: dt.datetime, run_id: str) -> str:
    return f"{base.rstrip('/')}/{table}/{run_ts:%Y/%m/%d}/run_id={run_id}"


def write_snapshot(df: DataFrame, base: str, table: str, run_ts: dt.datetime, run_id: str) -> str:
    """Dated Parquet copy ``base/table/yyyy/MM/dd/run_id=X`` (run_id becomes a partition column
    when the day folder is read)."""
    path = snapshot_path(base, table, run_ts, run_id)
    df.write.mode("overwrite").parquet(path)
    return path


def write_version(spark: SparkSession, df: DataFrame, base: str) -> int:
    """Write ``df`` as the next version of a versioned table, then commit it.

    The data goes to a new ``v=<n>-<random>`` folder (readers of older versions are never
    disturbed); the commit appends ``n`` to the table's version log. A crash before the
    commit leaves the previous version current; a half-written folder is never read.
    """
    base = base.rstrip("/")
    v = (current_version(spark, base) or 0) + 1
    # a folder is written once and by one writer: what a crash left under this number is
    # never mixed with new files, nor is a version that another writer commits meanwhile
    folder = f"v={v}-{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(f"{base}/{folder}")
    _commit(spark, base, f"{v}\t{folder}")
    return v


def write_history(spark: SparkSession, merged: DataFrame, base: str) -> int:
    """Commit the outcome of a merge of a type-2 table's *current* rows; the new version's number.

    ``merged`` holds the next current rows and the versions that this merge closed. Both are written by one
    job into one new folder, apart by ``is_current``, and one log entry names it. Versions closed
    before are neither read nor written: they stay in the folders of the merges that closed them, so
    the history only grows. A crash before the log entry leaves the version before current.
    """
    base = base.rstrip("/")
    v = (current_version(spark, base) or 0) + 1
    folder = f"v={v}-{uuid.uuid4().hex[:12]}"
    live, closed = F.count_if(F.col("is_current")), F.count_if(~F.col("is_current"))
    counts = Observation()
    (merged.observe(counts, live.alias("live"), closed.alias("closed"))
     .write.mode("errorifexists").partitionBy("is_current").parquet(f"{base}/{folder}"))
    entry = "\t".join([str(v), folder, str(counts.get["live"]), str(counts.get["closed"]), merged.schema.json()])
    _commit(spark, base, entry)
    return v


def _commit(spark: SparkSession, base: str, entry: str) -> None:
    # one JVM-generated row (no Python-side data): the commit record
    spark.range(1).select(F.lit(entry).alias("value")).write.mode("append").text(f"{base}/{POINTER}")


def write_csv_extract(df: DataFrame, path: str, single_file: bool = False) -> str:
    """CSV with header for BI tools. ``single_file`` funnels through one task: use it only for
    small, bounded report outputs (aggregates, top-k), never for row-level tables."""
    out = df.coalesce(1) if single_file else df
    # keep values byte-exact: Spark's CSV writer trims surrounding spaces unless told not to
    (out.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path
