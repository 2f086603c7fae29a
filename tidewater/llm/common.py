"""Helpers shared by the operators of this package."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.session import checkpoint_dir

# Blank characters that part words where an operator counts words "as written".
BLANKS = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read again, so a lost executor costs
    only its running tasks, and two consumers do not compute ``df`` twice.
    """
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str = "rid") -> DataFrame:
    """Add a unique row number that changes with the file splits, so for rows that are stored before a second look."""
    return docs.withColumn(name, F.monotonically_increasing_id())


def with_row_id(docs: DataFrame, name: str = "rid") -> DataFrame:
    """Add a unique row number; ids, texts and whole rows may repeat or be NULL in the input.

    Numbers are stored with their rows, once. Counted anew in each job they would follow the
    file splits, which follow the registered cores, and a re-run shuffle's order of rows.
    """
    return stored(numbered(docs, name), "rows", compression="zstd")


def packed(docs: DataFrame) -> DataFrame:
    """(rid, doc): each row whole under a number, so that its columns clash with none of an operator's."""
    return with_row_id(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")))


def held_out_bucket(doc_id: Column, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % buckets


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Fewest bands of ``rows`` MinHash values that collide with probability ``recall`` at ``threshold``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


def crc32_sql(name: str, texts: str) -> str:
    """DuckDB CTEs (in a WITH RECURSIVE) ending in ``name`` (s, crc): CRC-32 of each ASCII text ``s`` of the relation ``texts``."""
    return f"""
{name}_steps(s, i, k, c) AS (   -- k-th bit of the i-th byte; 3988292384: fixed value, the reflected polynomial
  SELECT s, 1, 0, CAST(4294967295 AS BIGINT) FROM {texts}
  UNION ALL
  SELECT s, CASE WHEN k = 7 THEN i + 1 ELSE i END, (k + 1) % 8, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END
  FROM (SELECT s, i, k, CASE WHEN k = 0 THEN xor(CAST(ascii(substr(s, i, 1)) AS BIGINT), c) ELSE c END AS c
        FROM {name}_steps WHERE i <= length(s))),
{name} AS (SELECT s, xor(c, 4294967295) AS crc FROM {name}_steps WHERE i > length(s))"""
