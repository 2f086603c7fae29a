"""Quality rules as weak supervision.

Each rule looks at one statistic of a text and votes good, bad or abstains. No rule
decides alone: expectation-maximisation estimates, without labels, how often each rule
votes what on good and on bad texts, and a text is kept if the posterior probability that
it is good reaches a threshold. The statistics, votes and posterior are column
expressions; the EM runs on the counts of vote patterns, of which there are at most
3 ** rules however many texts there are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import BLANKS, stored

_BLANK_CHARS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"

#: rule -> (statistic, bad if below, good from, good up to, bad if above); between them it abstains.
#: Rules that look for one defect never vote good: a text may lack it and have another.
NEVER = (1.0, 0.0)
RULES: dict[str, tuple[str, float, float, float, float]] = {
    "symbols": ("symbols_per_word", -1.0, *NEVER, 0.1),
    "dup_lines": ("dup_line_share", -1.0, *NEVER, 0.2),
    "repeats": ("repeat_share", -1.0, *NEVER, 0.2),
    "upper": ("upper_share", -1.0, *NEVER, 0.2),
    "marks": ("mark_share", -1.0, *NEVER, 0.6),
    "word_length": ("mean_word_chars", 3.5, 4.4, 5.9, 6.5),
    "short_words": ("short_word_share", 0.15, 0.3, 0.7, 0.9),
}
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_short", "n_marks")


def words_of(text: Column) -> Column:
    """The runs of non-blank characters."""
    body = F.btrim(text, F.lit(_BLANK_CHARS))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, BLANKS))


def statistics(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns in ``carry`` and STATS (long) of each row; NULL text counts as empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), *carry, text.alias("t"))
    d = d.select("doc_id", *carry, "t", words_of(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))
    d = d.select("doc_id", *carry, "t", "w", "lines", F.size("w").alias("n"))
    w = F.col("w")
    windows = F.when(F.col("n") >= 3, F.transform(
        F.sequence(F.lit(0), F.col("n") - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    ).otherwise(F.array().cast("array<bigint>"))
    d = d.select("*", windows.alias("g"))
    d = d.select("*", (F.size(F.array_distinct("g")) < F.size("g")).alias("repeats"))
    g = F.when(F.col("repeats"), F.col("g")).otherwise(F.array().cast("array<bigint>"))
    # windows sorted by value, so that equal ones stand side by side: n log n in the length of the text
    d = d.select("*", F.array_sort(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))).alias("s"))
    # "s" is read three times below, so Spark computes it once per row and not once per element
    s = F.col("s")
    same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
    d = d.select("*", F.array_sort(F.transform(
        F.filter(s, lambda x, k: same(F.get(s, k - 1), x) | same(F.get(s, k + 1), x)), lambda x: x["i"])).alias("p"))
    p = F.col("p")
    steps = F.transform(p, lambda i, k: F.least(F.lit(3), F.get(p, k + 1) - i))
    return d.select(
        "doc_id", *carry, F.col("n").cast("bigint").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.aggregate(steps, F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        (F.char_length("t") - F.char_length(F.regexp_replace("t", r"\p{Lu}+", ""))).cast("bigint").alias("n_upper"),
        F.size(F.filter(w, lambda x: F.char_length(x) <= 3)).cast("bigint").alias("n_short"),
        F.regexp_count("t", F.lit(r"[.,!?;:|]")).cast("bigint").alias("n_marks"))


def ratios(stats: DataFrame) -> dict[str, Column]:
    """The statistics that the rules look at; NULL (every rule abstains) where there is nothing to divide by."""
    per = lambda a, b: F.col(a) / F.when(F.col(b) > 0, F.col(b))
    return {"symbols_per_word": per("n_symbols", "n_words"), "dup_line_share": per("n_dup_lines", "n_lines"),
            "repeat_share": per("n_repeat_words", "n_words"), "mean_word_chars": per("word_chars", "n_words"),
            "upper_share": per("n_upper", "word_chars"), "short_word_share": per("n_short", "n_words"),
            "mark_share": per("n_marks", "n_words")}


def votes(stats: DataFrame) -> DataFrame:
    """Adds ``votes``: array<int> in the order of RULES, 1 good, -1 bad, 0 abstains."""
    ratio = ratios(stats)

    def vote(name: str) -> Column:
        stat, bad_below, good_from, good_to, bad_above = RULES[name]
        x = ratio[stat]
        return (F.when((x < bad_below) | (x > bad_above), -1).when((x >= good_from) & (x <= good_to), 1).otherwise(0))
    return stats.withColumn("votes", F.array(*[vote(r) for r in RULES]))


def estimate(patterns: list[tuple[list[int], int]], rounds: int = 500, prior: float = 0.8,
             accuracy: float = 0.8) -> tuple[float, list[dict[int, tuple[float, float]]]]:
    """EM over vote patterns and their counts: the share of good texts, and for each rule
    vote -> (probability on good texts, on bad texts). Starts from rules that are right
    ``accuracy`` of the time they vote; counts are smoothed by one text for each vote and class.
    """
    n_rules = len(RULES)
    table = [{1: (accuracy, 1 - accuracy), -1: (1 - accuracy, accuracy), 0: (1.0, 1.0)} for _ in range(n_rules)]
    total = sum(c for _, c in patterns)
    if not total:
        return prior, table
    for _ in range(rounds):
        good = 0.0
        seen = [{v: [1.0, 1.0] for v in (1, 0, -1)} for _ in range(n_rules)]
        for vs, c in patterns:
            z = math.log(prior / (1 - prior)) + sum(math.log(table[r][v][0] / table[r][v][1]) for r, v in enumerate(vs))
            g = c / (1 + math.exp(-max(-700.0, min(700.0, z))))
            good += g
            for r, v in enumerate(vs):
                seen[r][v][0] += g
                seen[r][v][1] += c - g
        new = [{v: (a / (good + 3), b / (total - good + 3)) for v, (a, b) in rule.items()} for rule in seen]
        moved = max(abs(new[r][v][k] - table[r][v][k]) for r in range(n_rules) for v in (1, 0, -1) for k in (0, 1))
        prior, table = min(max((good + 1) / (total + 2), 1e-6), 1 - 1e-6), new
        if moved < 1e-9:
            break
    return prior, table


def posterior(vs: Column, prior: float, table: list[dict[int, tuple[float, float]]]) -> Column:
    """Probability that a text with these votes is good."""
    z = F.lit(math.log(prior / (1 - prior)))
    for r, rule in enumerate(table):
        step = {v: math.log(g / b) for v, (g, b) in rule.items()}
        z = z + F.when(vs[r] == 1, step[1]).when(vs[r] == -1, step[-1]).otherwise(step[0])
    return 1 / (1 + F.exp(-z))


def quality_rules(docs: DataFrame, threshold: float = 0.95, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, posterior.

    Rows are independent but for the estimated accuracies, so repeated rows, ties and NULL
    ids each keep their row; a text without words fails the base rules; an empty table gives
    no rows. The statistics are stored once and read for the pattern counts and the verdicts.
    """
    s = stored(votes(statistics(docs, text_col, id_col)), "quality-votes")
    counted = s.groupBy("votes").count().collect()  # at most 3 ** len(RULES) rows
    prior, table = estimate([(list(r["votes"]), r["count"]) for r in counted])
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (s.withColumn("posterior", posterior(F.col("votes"), prior, table)).withColumn("base_failed", base)
            .select("doc_id", *STATS[:5], "base_failed",
                    (~F.col("base_failed") & (F.col("posterior") >= threshold)).alias("kept"), "posterior"))
