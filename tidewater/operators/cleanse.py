"""Bronze -> silver by configuration: a source is described, not programmed.

A :class:`SourceConfig` gives every column a role (what kind of value it should hold), the
columns derived from others, and where violations are. ``cleanse`` and ``violations_long``
work for any source so described.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions import (clean_name, parse_date, safe_cast, safe_int, trim_spaces, upper_trim, zip_first5, zip_pad)
from tidewater.functions.keys import hash_key
from tidewater.functions.violations import delimited_parts, slot_parts
from tidewater.operators.reshape import discover_slots
from tidewater.session import stored

#: role of a column -> how a value of it is made clean
ROLES: dict[str, Callable[[str], Column]] = {
    "name": clean_name,
    "text": trim_spaces,
    "place": upper_trim,
    "zip": zip_pad,
    "zip_or_longer": zip_first5,
    "date": parse_date,
    "date_or_iso": lambda c: parse_date(c, iso_fallback=True),
    "number": lambda c: safe_cast(c, "double"),
    "whole_number": safe_int,
}


@dataclass(frozen=True)
class Delimited:
    """Violations in one text cell, parted by a delimiter."""
    column: str
    delimiter: str = r"\|"


@dataclass(frozen=True)
class Slots:
    """Violations in repeated column groups ``prefix_Field_n``; ``main`` fills a slot."""
    prefix: str
    main: str
    points: str | None = None
    comments: str | None = None


@dataclass(frozen=True)
class SourceConfig:
    name: str
    roles: dict[str, str]                                    # column -> role; a column not named stays as it is
    violations: Delimited | Slots
    constants: dict[str, str] = field(default_factory=dict)  # column -> value
    derived: dict[str, Callable[[], Column]] = field(default_factory=dict)       # from raw columns
    scored: dict[str, Callable[[], Column]] = field(default_factory=dict)        # from clean columns
    id_column: str = "Inspection_ID"
    make_id: bool = False                                    # the source has no id of its own


COPIES_TOGETHER = 1000   # copies of one row that are numbered by one task at a time
MOST_BITS = 1 << 28      # of the bitmap of shared hashes that every task gets: 32 MB
PIECE_BYTES = 256        # of the bitmap, looked up together


def _may_be_in(df: DataFrame, hashes: DataFrame, column: str, flag: str) -> DataFrame:
    """``df`` with ``flag``: false only where ``column`` (bigint) is not in ``hashes``.

    Looked up in a bitmap of bounded size, about 16 bits for each hash while they fit; beyond
    that more rows are flagged that need not be.
    """
    bits = min(MOST_BITS, 1 << max(15, (16 * hashes.count()).bit_length()))
    place = F.pmod(F.col(column), F.lit(bits))
    # bitmaps of 2 ** 15 bits, then cut into pieces that are small enough to be copied for each row
    whole = (hashes.groupBy(F.shiftright(place, 15).alias("_part"))
             .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit((1 << 15) - 1))).alias("_bitmap")))
    pieces = stored(whole.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit((1 << 12) // PIECE_BYTES - 1))))
                    .select((F.col("_part") * ((1 << 12) // PIECE_BYTES) + F.col("_i")).alias("_piece"),
                            F.substring("_bitmap", F.col("_i") * PIECE_BYTES + 1, F.lit(PIECE_BYTES)).alias("_bits")), "bitmap")
    byte = F.floor(F.pmod(place, F.lit(8 * PIECE_BYTES)) / 8).cast("int")
    held = F.conv(F.hex(F.substring("_bits", byte + 1, F.lit(1))), 16, 10).cast("int")
    found = df.withColumn("_piece", F.floor(place / (8 * PIECE_BYTES))).join(F.broadcast(pieces), "_piece", "left")
    return found.withColumn(flag, F.coalesce(F.getbit(held, F.pmod(place, F.lit(8)).cast("int")) == 1, F.lit(False))).drop("_piece", "_bits")


def number_copies(df: DataFrame, id_column: str) -> DataFrame:
    """Add an id to each row: a hash of all its columns and of its number among exact copies.

    The same on any partitioning, and each row has its own. First 64-bit hashes of the rows are
    counted (an action): a row whose hash no other row has has no copy, and is neither grouped nor
    shuffled, unless its place in the bitmap of the other hashes is taken. Equal rows among the rest are counted map-side,
    then dealt out in runs of COPIES_TOGETHER over all tasks, so a row that makes up a third of the
    table is made, cleansed and written by no task alone.
    """
    raw = list(df.columns)
    row = F.xxhash64(*[f"`{c}`" for c in raw]).alias("_row")
    shared = stored(df.select(row).groupBy("_row").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_row"), "shared-hashes")
    hashed = _may_be_in(df.select("*", row), shared, "_row", "_shared")
    one = F.lit(1).cast("bigint").alias("_copy")
    alone = hashed.where("not _shared").select(*[f"`{c}`" for c in raw], one)
    counted = hashed.where("_shared").groupBy(*[f"`{c}`" for c in raw]).agg(F.count(F.lit(1)).alias("_copies"))
    runs = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / COPIES_TOGETHER))
    first = F.col("_run") * COPIES_TOGETHER
    again = (counted.where("_copies > 1").withColumn("_run", F.explode(runs)).repartition(*[f"`{c}`" for c in raw], "_run")
             .withColumn("_copy", F.explode(F.sequence(first + 1, F.least(first + COPIES_TOGETHER, F.col("_copies")))))
             .drop("_copies", "_run"))
    counted_once = counted.where("_copies = 1").select(*[f"`{c}`" for c in raw], one)
    return counted_once.unionByName(again).unionByName(alone).withColumn(id_column, hash_key([*[f"`{c}`" for c in raw], "_copy"])).drop("_copy")


def cleanse(bronze: DataFrame, cfg: SourceConfig) -> DataFrame:
    """Every column by its role, then what follows from the clean columns. No row is dropped."""
    df = number_copies(bronze, cfg.id_column) if cfg.make_id else bronze
    columns = {c: ROLES[role](c) for c, role in cfg.roles.items()}
    columns |= {c: make() for c, make in cfg.derived.items()}
    columns |= {c: F.lit(v) for c, v in cfg.constants.items()} | {"source_city": F.lit(cfg.name)}
    df = df.withColumns(columns)
    return df.withColumns({c: make() for c, make in cfg.scored.items()}) if cfg.scored else df


def _entries(df: DataFrame, cfg: SourceConfig, dotall: bool) -> Column:
    """array<struct<code, description, comments, points>>: the violations of a row, parsed."""
    def entry(parts: dict[str, Column], comments: Column, points: Column) -> Column:
        return F.struct(parts["violation_code"].alias("violation_code"),
                        parts["violation_description"].alias("violation_description"),
                        comments.alias("violation_comments"), points.alias("violation_points"))
    v = cfg.violations
    if isinstance(v, Delimited):
        cells = F.filter(F.transform(F.split(F.col(v.column), v.delimiter), lambda x: F.trim(x)), lambda x: x != "")

        def parse(x: Column) -> Column:
            parts = delimited_parts(x, fallback=True, dotall=dotall)
            return entry(parts, parts["violation_comments"], F.lit(None).cast("int"))
        return F.transform(cells, parse)
    slots = discover_slots(df.columns, v.prefix, v.main)
    if not slots:
        raise ValueError(f"no {v.prefix}_{v.main}_<n> columns found")

    def cell(name: str | None, n: int) -> Column:
        column = f"{v.prefix}_{name}_{n}"
        return F.col(column) if name and column in df.columns else F.lit(None).cast("string")
    filled = F.filter(F.array(*[F.struct(cell(v.main, n).alias("main"), cell(v.comments, n).alias("comments"),
                                         cell(v.points, n).try_cast("int").alias("points")) for n in slots]),
                      lambda s: F.coalesce(s["main"] != "", F.lit(False)))
    return F.transform(filled, lambda s: entry(slot_parts(s["main"], fallback=True), s["comments"], s["points"]))


def violations_long(clean: DataFrame, cfg: SourceConfig, dotall: bool = False) -> DataFrame:
    """One row per different (code, description) of each row of ``clean``, least comments and points first.

    A row's violations are all in that row, so they are told apart there, before they become
    rows, and nothing is shuffled. Ids must be one per row (:func:`number_copies` gives them).
    """
    found = F.array_sort(_entries(clean, cfg, dotall))
    df = clean.select(cfg.id_column, "source_city", found.alias("_v"))
    same = lambda a, b: (a["violation_code"].eqNullSafe(b["violation_code"])
                         & a["violation_description"].eqNullSafe(b["violation_description"]))
    first = F.filter("_v", lambda x, i: (i == 0) | ~same(F.get(F.col("_v"), i - 1), x))
    return (df.select(cfg.id_column, "source_city", F.inline(first))
            .select(cfg.id_column, "violation_code", "violation_description", "violation_comments", "violation_points", "source_city"))
