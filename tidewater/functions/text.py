"""Column-level cleansing helpers (pure Column -> Column, no actions, ANSI-safe)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

ColumnOrName = Column | str

# ---- fixed values (must match the source rules) -----------------------------------
ZIP5_PATTERN = r"^\d{5}$"           # valid zip after normalisation
ZIP_FLOAT_SUFFIX = r"\.0$"          # artefact of numeric inference on zips
ZIP_LEADING5 = r"^(\d{5})"          # first five digits of ZIP+4
LAT_PATTERN = r"\(([^,]+),"         # "... (lat, long)" -> lat
LONG_PATTERN = r",\s*([^)]+)\)"     # "... (lat, long)" -> long
RAW_DATE_FORMAT = "MM/dd/yyyy"
# -----------------------------------------------------------------------------------


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_blank(c: ColumnOrName, dtype: DataType | None = None) -> Column:
    """NULL, or the empty string for string columns (no trimming: ' ' is not blank)."""
    col = _c(c)
    if dtype is not None and not isinstance(dtype, StringType):
        return col.isNull()
    return col.isNull() | (col == F.lit(""))


def not_blank(c: ColumnOrName) -> Column:
    col = _c(c)
    return col.isNotNull() & (col != F.lit(""))


def blank_to_null(c: ColumnOrName) -> Column:
    return F.nullif(_c(c), F.lit(""))


def trim_spaces(c: ColumnOrName) -> Column:
    """Strip leading/trailing spaces only (tabs are kept, like SQL TRIM)."""
    return F.trim(_c(c))


def clean_name(c: ColumnOrName) -> Column:
    """Remove every double quote, then trim spaces."""
    return F.trim(F.regexp_replace(_c(c), '"', ""))


def upper_trim(c: ColumnOrName) -> Column:
    return F.trim(F.upper(_c(c)))


def zip_pad(c: ColumnOrName) -> Column:
    """Zip as text: drop a trailing '.0', left-pad a 4-digit zip with one '0'."""
    z = F.regexp_replace(_c(c).cast("string"), ZIP_FLOAT_SUFFIX, "")
    return F.when(F.length(z) == 4, F.concat(F.lit("0"), z)).otherwise(z)


def zip_first5(c: ColumnOrName) -> Column:
    """Zip as text: drop a trailing '.0', keep the first five leading digits, '' -> NULL."""
    z = F.regexp_replace(_c(c).cast("string"), ZIP_FLOAT_SUFFIX, "")
    return F.nullif(F.regexp_extract(z, ZIP_LEADING5, 1), F.lit(""))


def is_zip5(c: ColumnOrName) -> Column:
    col = _c(c)
    return col.isNotNull() & col.rlike(ZIP5_PATTERN)


def parse_date(c: ColumnOrName, fmt: str = RAW_DATE_FORMAT, iso_fallback: bool = False) -> Column:
    """Text -> date; unparseable -> NULL instead of an ANSI error.

    ``iso_fallback`` also accepts ISO ``yyyy-MM-dd`` text when the format does not match.
    """
    col = _c(c).cast("string")
    d = F.try_to_date(col, fmt)
    if iso_fallback:
        d = F.coalesce(d, col.try_cast("date"))
    return d


def safe_cast(c: ColumnOrName, dtype: str) -> Column:
    """``try_cast``: text artefacts and '' become NULL rather than failing the job."""
    return _c(c).try_cast(dtype)


def safe_int(c: ColumnOrName) -> Column:
    """Integer text -> int; '95.7' or junk -> NULL (Spark string->int semantics)."""
    return _c(c).cast("string").try_cast("int")


def latitude_from(c: ColumnOrName) -> Column:
    return F.regexp_extract(_c(c), LAT_PATTERN, 1).try_cast("double")


def longitude_from(c: ColumnOrName) -> Column:
    return F.regexp_extract(_c(c), LONG_PATTERN, 1).try_cast("double")


def mentions_any(c: ColumnOrName, words: list[str]) -> Column:
    """Case-insensitive 'contains any of the words' (regex alternation)."""
    return _c(c).rlike("(?i)(" + "|".join(words) + ")")
