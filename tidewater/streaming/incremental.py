"""Incremental bronze -> silver over newly arriving raw files (Structured Streaming).

The cleansing, rule and violation operators are stateless, so they run unchanged on
each micro-batch. ``foreachBatch`` writes every output of a batch from ONE flagged
frame (rules evaluated once), and the checkpoint location (under the shared
``spark.checkpoint.dir``) makes file discovery and the sinks exactly-once across
restarts and lost executors. ``available_now`` processes the backlog and stops, which
suits scheduled runs; without it the query keeps running on a processing-time trigger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewater.operators import columns as C
from tidewater.operators import quality as Q
from tidewater.operators import cleanse as CL
from tidewater.plans import silver as V
from tidewater.session import scratch_path

SOURCES = {
    "north": (lambda b: CL.cleanse(b, V.NORTH), V.north_rules, lambda ok: CL.violations_long(ok, V.NORTH)),
    "south": (V.south_clean, V.south_rules, lambda ok: CL.violations_long(ok, V.SOUTH)),
}


def raw_stream(spark: SparkSession, path: str, schema: StructType, max_files_per_trigger: int = 1000) -> DataFrame:
    """Multi-line CSV files appearing under ``path`` (explicit all-string schema)."""
    return (spark.readStream.schema(schema)
            .option("header", True).option("multiLine", True).option("escape", '"')
            .option("maxFilesPerTrigger", max_files_per_trigger)
            .csv(path))


def _batch_writer(source: str, out_base: str, job_id: str) -> Callable[[DataFrame, int], None]:
    cleanse, rules_fn, viol_fn = SOURCES[source]

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = rules_fn()
        bronze = C.add_bronze_lineage(C.sanitize_columns(batch), source, job_id)
        flagged = Q.flag_rules(cleanse(bronze), rules)
        # the batch is re-read by three sinks; cache it for the batch only (a lost block
        # is recomputed from the batch's files)
        flagged.persist()
        try:
            ok = Q.passed(flagged)
            # each batch owns its folder and overwrites it: a batch replayed after a
            # failure replaces its own output instead of appending a second copy
            part = f"batch_id={batch_id}"
            C.drop_columns(ok, prefixes=["Violation"]).write.mode("overwrite") \
                .parquet(f"{out_base}/{source}_inspections/{part}")
            viol_fn(ok).write.mode("overwrite").parquet(f"{out_base}/{source}_violations/{part}")
            Q.quarantined(flagged, rules).write.mode("overwrite") \
                .parquet(f"{out_base}/{source}_quarantine/{part}")
        finally:
            flagged.unpersist()

    return write


def start_silver_stream(spark: SparkSession, source: str, raw_path: str, schema: StructType, out_base: str,
                        checkpoint: str | None = None, job_id: str = "stream",
                        available_now: bool = True, interval: str = "1 minute") -> StreamingQuery:
    """Start the incremental silver job for one source shape (``north`` or ``south``).

    A batch that fails midway is re-run with the same ``batch_id`` after restart and
    overwrites its own ``batch_id=N`` folders, so the output is exactly-once; reading an
    output folder yields every batch with a ``batch_id`` column.
    """
    ckpt = checkpoint or scratch_path(spark, f"streams/silver_{source}")
    writer = (raw_stream(spark, raw_path, schema).writeStream
              .foreachBatch(_batch_writer(source, out_base, job_id))
              .option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
