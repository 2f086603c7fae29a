"""Score <-> result mappings, score bins and row-wise counts."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewater.functions.text import ColumnOrName, _c, not_blank

# ---- fixed values (labels and thresholds of the inspection rules) -----------------
RESULT_PASS = "Pass"
RESULT_CONDITIONAL = "Pass w/ Conditions"
RESULT_FAIL = "Fail"
RESULT_NO_ENTRY = "No Entry"
# result -> score (case-sensitive): Pass 90, Pass w/ Conditions 80, Fail 70, No Entry 0
RESULT_SCORES = [(RESULT_PASS, 90), (RESULT_CONDITIONAL, 80), (RESULT_FAIL, 70), (RESULT_NO_ENTRY, 0)]
# score -> result: >=90 Pass, >=80 Pass w/ Conditions, otherwise Fail
SCORE_RESULTS = [(90, RESULT_PASS), (80, RESULT_CONDITIONAL), (70, RESULT_FAIL)]
# score bins: >=90, >=80, >=70, >=0, else (negatives and NULL)
SCORE_BINS = [(90, "90-100 (Excellent)"), (80, "80-89 (Good)"), (70, "70-79 (Fair)"), (0, "0-69 (Poor)")]
NO_SCORE = "No Score"
# -----------------------------------------------------------------------------------


def score_from_result(c: ColumnOrName) -> Column:
    col = _c(c)
    expr = None
    for label, score in RESULT_SCORES:
        expr = (F.when(col == label, F.lit(score)) if expr is None
                else expr.when(col == label, F.lit(score)))
    return expr.otherwise(F.lit(None).cast("int"))


def result_from_score(c: ColumnOrName) -> Column:
    """>=90 Pass, >=80 Pass w/ Conditions, any other non-NULL score Fail, NULL -> NULL."""
    col = _c(c)
    expr = None
    for threshold, label in SCORE_RESULTS:
        expr = (F.when(col >= threshold, F.lit(label)) if expr is None
                else expr.when(col >= threshold, F.lit(label)))
    return expr.when(col < SCORE_RESULTS[-1][0], F.lit(RESULT_FAIL)).otherwise(F.lit(None).cast("string"))


def score_bin(c: ColumnOrName) -> Column:
    col = _c(c)
    expr = None
    for threshold, label in SCORE_BINS:
        expr = (F.when(col >= threshold, F.lit(label)) if expr is None
                else expr.when(col >= threshold, F.lit(label)))
    return expr.otherwise(F.lit(NO_SCORE))


def nonblank_count(cols: list[ColumnOrName]) -> Column:
    """Number of the given columns that are neither NULL nor ''."""
    if not cols:
        return F.lit(0)
    return reduce(add, [F.when(not_blank(c), F.lit(1)).otherwise(F.lit(0)) for c in cols])
