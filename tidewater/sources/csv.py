"""CSV ingestion with explicit schemas.

Bronze is read as all-string columns (no inference pass, no float-mangled zips); typing
happens in silver with ``try_cast``. Multi-line CSV files are not splittable, so ingest
many files (one task each) and convert to Parquet once in bronze.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidewater.session import stored


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType(), True) for c in columns])


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
             multiline: bool = True, infer: bool = False, header: bool = True) -> DataFrame:
    """Header CSV; ``multiline`` keeps quoted newlines in one row and reads ``""`` as ``"``.

    Without a schema, ``infer=False`` reads every column as string (header names).
    """
    reader = (spark.read.option("header", header)
              .option("mode", "PERMISSIVE")
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if multiline:
        reader = reader.option("multiLine", True).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer)
    return reader.csv(path)


BAD = "_corrupt_record"


@dataclass
class CheckedCsv:
    """Rows that fit the schema; (file, record) of those that do not; (file, seen, kept, quarantined)."""
    rows: DataFrame
    bad: DataFrame
    counts: DataFrame


def read_csv_checked(spark: SparkSession, path: str | list[str], schema: StructType, multiline: bool = True, header: bool = True) -> CheckedCsv:
    """As :func:`read_csv` with a schema, but records with missing or surplus cells are kept apart, as they stand in the file.

    The files are parsed once, into a stored table that all three results are read from. A quote
    that is never closed takes in what follows, up to the end of its line or, with ``multiline``, of its file: one bad
    record.
    """
    if BAD in schema.names:
        raise ValueError(f"the schema has a column {BAD}")
    reader = (spark.read.schema(StructType([*schema.fields, StructField(BAD, StringType())])).option("header", header)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).option("columnPruning", False).option("escape", '"')
              .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("multiLine", multiline))
    parsed = stored(reader.csv(path).withColumn("_file", F.col("_metadata.file_path")), "csv-checked")
    bad = F.col(BAD).isNotNull()
    return CheckedCsv(parsed.where(~bad).select(*[f"`{c}`" for c in schema.names]),
                      parsed.where(bad).select(F.col("_file").alias("file"), F.col(BAD).alias("record")),
                      parsed.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("seen"), F.count_if(~bad).alias("kept"),
                                                                      F.count_if(bad).alias("quarantined")))
