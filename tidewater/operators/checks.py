"""Data-quality checks read from metadata: row checks and checks over whole groups of rows.

A check is a dict (or an entry of a JSON list)::

    {"name": "id_not_null", "criticality": "error",          # or "warn"
     "check": {"function": "is_not_null", "arguments": {"column": "id"}},
     "filter": "source = 'a'"}                               # optional: rows it applies to

Names, functions, arguments and columns are checked before anything runs. Row checks become
expressions of one projection. Dataset checks (unique keys, foreign keys, bounds on aggregates)
are grouped by their grain, the columns they look at: one aggregate for each grain finds the
failing keys of all its checks, and only those are joined back to the rows.
"""

from __future__ import annotations

import inspect
import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.operators.quality import ERROR, WARN
from tidewater.operators.skew import join_counted, null_safe
from tidewater.session import stored

ROW_CHECKS: dict[str, Callable[..., Column]] = {}
DATASET_CHECKS: dict[str, Callable[..., "Grain"]] = {}
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count_distinct": F.count_distinct}
COLUMN_ARGUMENTS = ("column", "columns", "group_by")


@dataclass(frozen=True)
class Grain:
    """What a dataset check needs: its key columns, an aggregate over the rows it applies to, and when a key fails."""
    columns: tuple[str, ...]
    value: Callable[[Column], Column] | None        # (row applies) -> aggregate
    fails: Callable[[Column], Column]               # (aggregate, or whether the key is known) -> failed
    ref: str | None = None                          # frame that must know the key
    ref_columns: tuple[str, ...] = ()


@dataclass(frozen=True)
class Bound:
    name: str
    criticality: str
    applies: Column | None
    passes: Column | None = None
    grain: Grain | None = None


def row_check(fn):
    """Register a function from arguments to a Column that is TRUE for rows that pass."""
    ROW_CHECKS[fn.__name__] = fn
    return fn


def dataset_check(fn):
    DATASET_CHECKS[fn.__name__] = fn
    return fn


# ---- row checks: a NULL value passes unless the name says otherwise -----------------------

def _or_null(column: str, test: Column) -> Column:
    return F.col(column).isNull() | test


@row_check
def is_not_null(column: str) -> Column:
    return F.col(column).isNotNull()


@row_check
def is_not_empty(column: str) -> Column:
    return _or_null(column, F.col(column).cast("string") != "")


@row_check
def is_not_null_and_not_empty(column: str, trim_strings: bool = False) -> Column:
    text = F.col(column).cast("string")
    return F.col(column).isNotNull() & ((F.trim(text) if trim_strings else text) != "")


@row_check
def is_in_list(column: str, allowed: list) -> Column:
    return _or_null(column, F.col(column).isin(*allowed))


@row_check
def is_not_null_and_is_in_list(column: str, allowed: list) -> Column:
    return F.col(column).isNotNull() & F.col(column).isin(*allowed)


@row_check
def is_in_range(column: str, min_limit, max_limit) -> Column:
    return _or_null(column, F.col(column).between(F.lit(min_limit), F.lit(max_limit)))


@row_check
def is_not_in_range(column: str, min_limit, max_limit) -> Column:
    return _or_null(column, ~F.col(column).between(F.lit(min_limit), F.lit(max_limit)))


@row_check
def is_not_less_than(column: str, limit) -> Column:
    return _or_null(column, F.col(column) >= F.lit(limit))


@row_check
def is_not_greater_than(column: str, limit) -> Column:
    return _or_null(column, F.col(column) <= F.lit(limit))


@row_check
def regex_match(column: str, regex: str, negate: bool = False) -> Column:
    found = F.col(column).cast("string").rlike(regex)
    return _or_null(column, ~found if negate else found)


@row_check
def is_valid_date(column: str, date_format: str | None = None) -> Column:
    return _or_null(column, F.try_to_date(F.col(column).cast("string"), *([date_format] if date_format else [])).isNotNull())


@row_check
def is_valid_timestamp(column: str, timestamp_format: str | None = None) -> Column:
    return _or_null(column, F.try_to_timestamp(F.col(column).cast("string"), *([F.lit(timestamp_format)] if timestamp_format else [])).isNotNull())


@row_check
def sql_expression(expression: str, negate: bool = False) -> Column:
    """TRUE passes; FALSE and NULL fail (with ``negate``: FALSE passes)."""
    test = F.expr(expression)
    return ~test if negate else test


# ---- dataset checks -----------------------------------------------------------------------

@dataset_check
def is_unique(columns: list[str], nulls_distinct: bool = True) -> Grain:
    """Rows whose key other rows have too fail; with ``nulls_distinct`` a key with a NULL is like no other."""
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return Grain(tuple(columns), lambda on: F.count_if(on & known if nulls_distinct else on), lambda n: n > 1)


@dataset_check
def foreign_key(columns: list[str], ref_columns: list[str], ref_df_name: str) -> Grain:
    """Rows whose key is not in the reference frame fail; a key with a NULL passes."""
    if len(columns) != len(ref_columns):
        raise ValueError(f"foreign_key: {len(columns)} columns against {len(ref_columns)}")
    full = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return Grain(tuple(columns), None, lambda found: full & ~found, ref_df_name, tuple(ref_columns))


def _bounded(column: str, aggr_type: str, group_by: list[str], fails: Callable[[Column], Column]) -> Grain:
    if aggr_type not in AGGREGATES:
        raise ValueError(f"unknown aggregate {aggr_type!r}; known: {sorted(AGGREGATES)}")
    value = F.lit(1) if column == "*" else F.col(column)
    return Grain(tuple(group_by), lambda on: AGGREGATES[aggr_type](F.when(on, value)), fails)


@dataset_check
def is_aggr_not_greater_than(column: str, limit, aggr_type: str = "count", group_by: list[str] = ()) -> Grain:
    """All rows of a group (without ``group_by``: all rows) fail if the aggregate is above the limit."""
    return _bounded(column, aggr_type, group_by, lambda v: v > F.lit(limit))


@dataset_check
def is_aggr_not_less_than(column: str, limit, aggr_type: str = "count", group_by: list[str] = ()) -> Grain:
    return _bounded(column, aggr_type, group_by, lambda v: v < F.lit(limit))


# ---- from metadata to rows ------------------------------------------------------------------

def bind(metadata: list[dict] | str, df: DataFrame, refs: dict[str, DataFrame] | None = None) -> list[Bound]:
    """Resolve checks against ``df``; raises ValueError on anything that does not fit."""
    checks = json.loads(metadata) if isinstance(metadata, str) else metadata
    out: list[Bound] = []
    for i, entry in enumerate(checks):
        if not isinstance(entry, dict) or not isinstance(entry.get("check"), dict):
            raise ValueError(f"check {i}: expected a dict with a 'check' dict, got {entry!r}")
        if extra := set(entry) - {"name", "criticality", "check", "filter"}:
            raise ValueError(f"check {i}: unknown fields {sorted(extra)}")
        function, args = entry["check"].get("function"), entry["check"].get("arguments", {})
        fn = ROW_CHECKS.get(function) or DATASET_CHECKS.get(function)
        if fn is None:
            raise ValueError(f"check {i}: unknown function {function!r}; known: {sorted([*ROW_CHECKS, *DATASET_CHECKS])}")
        try:
            inspect.signature(fn).bind(**args)
        except TypeError as e:
            raise ValueError(f"check {i}: {function}: {e}") from None
        named = [c for a in COLUMN_ARGUMENTS if a in args for c in ([args[a]] if isinstance(args[a], str) else args[a])]
        named = [c for c in named if c != "*"]
        if missing := [c for c in named if c not in df.columns]:
            raise ValueError(f"check {i}: {function}: no column {missing} in {df.columns}")
        name = entry.get("name") or "_".join([*named, function])
        if name in (b.name for b in out):
            raise ValueError(f"check {i}: name {name!r} is taken")
        criticality = entry.get("criticality", ERROR)
        if criticality not in (ERROR, WARN):
            raise ValueError(f"check {i}: criticality {criticality!r} is neither {ERROR!r} nor {WARN!r}")
        applies = F.coalesce(F.expr(entry["filter"]), F.lit(False)) if entry.get("filter") else None
        if function in ROW_CHECKS:
            out.append(Bound(name, criticality, applies, passes=fn(**args)))
            continue
        grain = fn(**args)
        if grain.ref is not None:
            if grain.ref not in (refs or {}):
                raise ValueError(f"check {i}: no reference frame {grain.ref!r}")
            if missing := [c for c in grain.ref_columns if c not in refs[grain.ref].columns]:
                raise ValueError(f"check {i}: no column {missing} in reference {grain.ref!r}")
        out.append(Bound(name, criticality, applies, grain=grain))
    return out


def _failing_keys(df: DataFrame, checks: dict[int, Bound], columns: tuple[str, ...], refs: dict[str, DataFrame]) -> DataFrame:
    """(columns, n, failed): keys that fail a check, how many rows have them and the numbers of the checks."""
    every = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, b in checks.items():
        on = every if b.applies is None else b.applies
        aggs.append((b.grain.value(on) if b.grain.value else F.count_if(on)).alias(f"_a{i}"))
    keyed = df.groupBy(*[F.col(c) for c in columns]).agg(*aggs)
    for i, b in checks.items():
        if b.grain.ref is not None:   # keys, not rows, meet the reference's keys
            mine = [f"_r{i}_{k}" for k in range(len(columns))]
            known = (refs[b.grain.ref].select(*[F.col(c).alias(m) for c, m in zip(b.grain.ref_columns, mine)]).distinct()
                     .withColumn(f"_found{i}", F.lit(True)))
            keyed = keyed.join(known, null_safe(list(columns), mine), "left").drop(*mine)
    failed = []
    for i, b in checks.items():
        verdict = (F.col(f"_a{i}") > 0) & b.grain.fails(F.col(f"_found{i}").isNotNull()) if b.grain.ref is not None else b.grain.fails(F.col(f"_a{i}"))
        failed.append(F.when(F.coalesce(verdict, F.lit(False)), F.lit(i)))
    return (keyed.select(*columns, "_n", F.array_compact(F.array(*failed)).alias("_keys_failed"))
            .where(F.size("_keys_failed") > 0))


def annotate(df: DataFrame, metadata: list[dict] | str, refs: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` with ``_errors`` and ``_warnings``: the names of the checks a row fails, in the order of the metadata."""
    checks = bind(metadata, df, refs)
    columns = df.columns
    by_grain: dict[tuple[str, ...], dict[int, Bound]] = {}
    for i, b in enumerate(checks):
        if b.grain is not None:
            by_grain.setdefault(b.grain.columns, {})[i] = b
    out, failures = df, {}
    for g, (grain, members) in enumerate(by_grain.items()):
        mark = f"_failed{g}"
        keys = _failing_keys(df, members, grain, refs or {})
        if grain:
            out = join_counted(out, stored(keys.withColumnRenamed("_keys_failed", mark), "failing-keys"), list(grain), "_n", mark)
        else:   # one row about the whole frame
            out = out.withColumn(mark, keys.select("_keys_failed").scalar())
        failures |= {i: F.coalesce(F.array_contains(mark, i), F.lit(False)) for i in members}

    def names(level: str) -> Column:
        found = []
        for i, b in enumerate(checks):
            if b.criticality == level:
                fails = failures[i] if b.grain is not None else ~F.coalesce(b.passes, F.lit(False))
                found.append(F.when(fails if b.applies is None else fails & b.applies, F.lit(b.name)))
        return F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return out.select(*[F.col(f"`{c}`") for c in columns], names(ERROR).alias("_errors"), names(WARN).alias("_warnings"))


def split_by_metadata(df: DataFrame, metadata: list[dict] | str, refs: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): rows that fail no error check; rows that fail any check, with the names."""
    marked = annotate(df, metadata, refs)
    return (marked.where(F.size("_errors") == 0).drop("_errors", "_warnings"),
            marked.where((F.size("_errors") > 0) | (F.size("_warnings") > 0)))
