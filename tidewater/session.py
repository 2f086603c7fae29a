"""SparkSession construction and cluster-safe defaults."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# JIT-compile large generated methods: wide projections (dozens of cleansing and rule
# expressions fused by whole-stage codegen) exceed HotSpot's 8 KB default and would run
# interpreted, several times slower.
JIT_HUGE_METHODS = "-XX:-DontCompileHugeMethods"

# Static settings for a session we launch ourselves (local runs, tests, bench). On a
# cluster the launcher owns static and JVM settings (see ``scale_conf``).
_LOCAL_STATIC = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.extraJavaOptions": JIT_HUGE_METHODS,
}

# SQL settings applied only when nobody (spark-defaults, --conf, ``extra``) set them.
_SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tidewater", extra: dict | None = None) -> SparkSession:
    """Return the active session, creating one if needed, filling only unset settings.

    ``master`` given means we launch the JVM ourselves (local mode), so static settings
    are ours to choose; ``extra`` always wins.
    """
    extra = dict(extra or {})
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        for k, v in _LOCAL_STATIC.items():
            if k not in extra:
                builder = builder.config(k, v)
    for k, v in extra.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    explicit = spark.sparkContext.getConf()
    for k, v in _SQL_DEFAULTS.items():
        if k not in extra and not explicit.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the launcher must set it to shared storage; only a local master gets a
    private scratch folder when it is unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="tidewater-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint dir for materialised intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what is written or collected meanwhile go as that ends, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stored(df, name: str):
    """Write ``df`` to a fresh folder of the shared checkpoint dir and read it back: computed once
    however often it is used, from files that any executor can read again."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)  # hex keys take half the room they do under snappy
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_local_path(path: str) -> bool:
    return "://" not in path or path.startswith("file:")


def ensure_local_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(path.replace("file:", ""), exist_ok=True)


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Suggested settings for a job reading ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions are sized so each starts near ``partition_bytes`` (AQE coalesces
    the small ones at runtime and splits skewed ones), never fewer than 2 waves of tasks.
    Pass the result as ``extra`` to :func:`get_spark` or to spark-submit ``--conf``.
    """
    import math
    parts = max(2 * total_cores, math.ceil(input_bytes / partition_bytes))
    mb = f"{partition_bytes >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": mb,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": mb,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": f"{2 * (partition_bytes >> 20)}m",
        "spark.executor.extraJavaOptions": JIT_HUGE_METHODS,
        "spark.driver.extraJavaOptions": JIT_HUGE_METHODS,
        # broadcast only what the planner measures below this size (a checked bound)
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }
