"""Deterministic keys: lineage hashes and 128-bit surrogate keys.

Keys are pure functions of business columns, so they are identical on every run, for any
partitioning, on any number of executors — unlike ``monotonically_increasing_id``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import ColumnOrName, _c

NULL_TOKEN = "NULL"   # fixed value: lineage hash spells NULL as the text 'NULL'
KEY_SEP = "|"


def durability_key(cols: list[ColumnOrName]) -> Column:
    """sha256 hex of the key columns joined by '||', NULL spelled 'NULL'.

    Note: a real string 'NULL' hashes like a NULL; kept as-is for compatibility.
    """
    parts = [F.coalesce(_c(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.sha2(F.concat_ws("||", *parts), 256)


def key_text(cols: list[ColumnOrName]) -> Column:
    """Unambiguous text encoding of a tuple: NULL -> '~', value v -> '=length:v', joined by '|'."""
    def part(c):
        v = _c(c).cast("string")
        return F.when(v.isNull(), F.lit("~")).otherwise(F.concat(F.lit("="), F.char_length(v), F.lit(":"), v))
    return F.concat_ws(KEY_SEP, *[part(c) for c in cols])


def packed_text(col: ColumnOrName) -> Column:
    """A text as bytes: one that is lowercase hex digits, as keys are, in half its length, any other as it is; NULL stays NULL."""
    c = _c(col)
    short = F.unhex(c)
    return F.when(F.lower(F.hex(short)) == c, F.concat(F.unhex(F.lit("01")), short)).otherwise(F.concat(F.unhex(F.lit("00")), c.cast("binary")))


def unpacked_text(col: ColumnOrName) -> Column:
    """The text of which ``packed_text`` made the bytes."""
    c = _c(col)
    rest = F.substring(c, 2, 1 << 30)
    return F.when(F.substring(c, 1, 1) == F.unhex(F.lit("01")), F.lower(F.hex(rest))).otherwise(rest.cast("string"))


def hash_key(cols: list[ColumnOrName]) -> Column:
    """md5 of key_text as 32 hex digits: all 128 bits, so that keys of 10^12 rows stay apart."""
    return F.md5(key_text(cols))
