"""Declarative data-quality rules: filter, audit and split (valid / quarantine).

Rules are boolean Columns meaning "keep". Three-valued logic is deliberate: a rule that
evaluates to NULL drops the row, exactly like ``DataFrame.filter``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.text import is_blank

ERROR = "error"
WARN = "warn"


@dataclass(frozen=True)
class Rule:
    name: str
    keep: Column


@dataclass(frozen=True)
class Check:
    """A named check with criticality ``error`` or ``warn``.

    ``fn`` is one of ``is_not_null`` / ``is_not_null_and_not_empty`` or a Column that
    is TRUE when the row passes.
    """

    name: str
    criticality: str
    column: str | None = None
    fn: str | Column = "is_not_null"

    def passes(self) -> Column:
        if isinstance(self.fn, Column):
            return F.coalesce(self.fn, F.lit(False))
        if self.fn == "is_not_null":
            return F.col(self.column).isNotNull()
        if self.fn == "is_not_null_and_not_empty":
            return ~is_blank(self.column)
        raise ValueError(f"unknown check function {self.fn!r}")


def apply_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Keep rows for which every rule is TRUE.

    One predicate: as separate conjuncts of one generated method, rules over cleansed columns
    outgrow what the JVM compiles and run interpreted.
    """
    if not rules:
        return df
    return df.filter(F.forall(F.array(*[r.keep for r in rules]), lambda kept: kept))


FAILED = "_failed"


def failed_rules(rules: list[Rule]) -> Column:
    """array<int>: 1-based numbers of the rules a row does not satisfy, in order; empty if all pass."""
    if not rules:
        return F.array().cast("array<int>")
    return F.filter(F.array(*[F.when(~F.coalesce(r.keep, F.lit(False)), F.lit(i)) for i, r in enumerate(rules, 1)]),
                    lambda x: x.isNotNull())


def flag_rules(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """All rows, plus ``_failed``: every rule is evaluated exactly once per row, so
    valid rows, quarantine and audit can all be derived from one written table."""
    return df.withColumn(FAILED, failed_rules(rules))


def passed(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(FAILED) == 0).drop(FAILED)


def quarantined(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rejected rows with the names of every rule they fail."""
    names = F.array(*[F.lit(r.name) for r in rules]) if rules else F.array().cast("array<string>")
    return (flagged.filter(F.size(FAILED) > 0)
            .withColumn("_failed_rules", F.transform(FAILED, lambda i: F.element_at(names, i))).drop(FAILED))


def audit_metrics(rules: list[Rule]) -> dict[str, Column]:
    """Aggregates over a flagged frame from which :func:`audit_rows` makes the audit; they can be observed while it is written."""
    failed = F.col(FAILED)
    out = {"rows_before": F.count(F.lit(1)), "rows_after": F.count_if(F.size(failed) == 0)}
    for i in range(len(rules)):
        out[f"d{i}"] = F.count_if(F.get(failed, F.lit(0)) == i + 1)
        out[f"a{i}"] = F.count_if(F.array_contains(failed, i + 1))
    return out


def audit_rows(totals: DataFrame, rules: list[Rule]) -> DataFrame:
    """The audit from one row of :func:`audit_metrics`."""
    rows = F.array(*[
        F.struct(F.lit(i + 1).alias("rule_order"), F.lit(r.name).alias("rule_name"),
                 F.col(f"d{i}").alias("dropped"), F.col(f"a{i}").alias("failed"))
        for i, r in enumerate(rules)])
    return totals.select(F.inline(rows), "rows_before", "rows_after")


def audit_from_flags(flagged: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule, in order: rows dropped by it (first failing rule), rows failing it at all,
    rows before and after — one aggregate over the flag column only."""
    return audit_rows(flagged.select(FAILED).agg(*[m.alias(n) for n, m in audit_metrics(rules).items()]), rules)


def rules_audit(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule, in order: rows dropped by it (first failing rule) and rows failing it at all.

    One scan, one aggregate: columns rule_order, rule_name, dropped, failed, rows_before, rows_after.
    """
    return audit_from_flags(flag_rules(df, rules), rules)


def dq_annotate(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Add ``_errors`` / ``_warnings``: arrays of failed check names (empty when clean)."""
    def failed(level):
        names = [F.when(~c.passes(), F.lit(c.name)) for c in checks if c.criticality == level]
        if not names:
            return F.array().cast("array<string>")
        return F.filter(F.array(*names), lambda x: x.isNotNull())
    return df.withColumns({"_errors": failed(ERROR), "_warnings": failed(WARN)})


def dq_split(df: DataFrame, checks: list[Check]) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) — valid: no error failed; quarantine: any error or warn failed.

    A row failing only warn checks is in both. Both outputs share one annotated plan:
    write them in one job (or write the annotated frame once) to scan the input once.
    """
    annotated = dq_annotate(df, checks)
    valid = annotated.filter(F.size("_errors") == 0).drop("_errors", "_warnings")
    quarantine = annotated.filter((F.size("_errors") > 0) | (F.size("_warnings") > 0))
    return valid, quarantine


def dq_summary(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One-row counts: total, valid, quarantined, and failures per check — single scan."""
    aggs = [F.count(F.lit(1)).alias("total")]
    err = [~c.passes() for c in checks if c.criticality == ERROR]
    anyf = [~c.passes() for c in checks]
    any_err = reduce(lambda a, b: a | b, err) if err else F.lit(False)
    any_fail = reduce(lambda a, b: a | b, anyf) if anyf else F.lit(False)
    aggs.append(F.count_if(~any_err).alias("valid"))
    aggs.append(F.count_if(any_fail).alias("quarantined"))
    for c in checks:
        aggs.append(F.count_if(~c.passes()).alias(f"failed_{c.name}"))
    return df.agg(*aggs)
