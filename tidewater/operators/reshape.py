"""Wide/long reshaping: delimited text -> rows, repeated column groups -> rows.

Both filter the array with a higher-order function *before* ``explode`` so blank
fragments never become rows (Catalyst does not push a filter below Generate).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import not_blank


def split_explode(df: DataFrame, col: str, delimiter_regex: str = r"\|", out: str = "fragment",
                  keep: list[str] | None = None, with_position: bool = False) -> DataFrame:
    """One row per non-blank, space-trimmed fragment of ``col`` split on ``delimiter_regex``.

    ``with_position`` adds the 1-based fragment position (over the kept fragments).
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c != col]
    parts = F.filter(F.transform(F.split(F.col(col), delimiter_regex), lambda x: F.trim(x)),
                     lambda x: x != "")
    if with_position:
        return df.select(*keep, F.posexplode(parts).alias("_pos", out)) \
                 .withColumn("fragment_pos", (F.col("_pos") + 1).cast("int")).drop("_pos")
    return df.select(*keep, F.explode(parts).alias(out))


def discover_slots(columns: list[str], prefix: str, main_field: str) -> list[int]:
    """Slot numbers present for ``{prefix}_{main_field}_{n}`` columns, in numeric order."""
    pat = re.compile(rf"^{re.escape(prefix)}_{re.escape(main_field)}_(\d+)$")
    return sorted(int(m.group(1)) for c in columns if (m := pat.match(c)))


def unpivot_slots(df: DataFrame, prefix: str, fields: dict[str, str], main_field: str,
                  keep: list[str], casts: dict[str, str] | None = None,
                  slot_name: str = "slot_num") -> DataFrame:
    """Repeated column groups ``{prefix}_{Field}_{n}`` -> one row per slot whose main field is
    not blank. ``fields`` maps source field -> output name; a slot whose main column is
    missing is skipped, other missing fields are typed NULL; ``casts`` use try_cast.
    """
    casts = casts or {}
    slots = discover_slots(df.columns, prefix, main_field)
    if not slots:
        raise ValueError(f"no {prefix}_{main_field}_<n> columns found")
    present = set(df.columns)
    structs = []
    for n in slots:
        members = [F.lit(n).alias(slot_name)]
        for src, name in fields.items():
            cname = f"{prefix}_{src}_{n}"
            c = F.col(cname) if cname in present else F.lit(None).cast("string")
            if name in casts:
                c = c.cast("string").try_cast(casts[name])
            members.append(c.alias(name))
        structs.append(F.struct(*members))
    main = fields[main_field]
    arr = F.filter(F.array(*structs), lambda s: not_blank(s[main]))
    return df.select(*keep, F.inline(arr))
