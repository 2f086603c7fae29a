"""Quality classifier: a sparse rule ensemble over text statistics.

A forest of shallow trees is grown on labelled texts, every path from a root becomes a
conjunctive rule over the statistics, a lasso logistic regression weighs the rules and
drops many of them, its penalty chosen on labelled rows held back from it, and the rest are compiled into one Spark column: the score of a text
is the logistic function of the summed weights of the rules it meets. Only fitting is
iterative, and on a bounded sample; scoring is a projection.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm import quality_rules
from tidewater.llm.common import held_out_bucket, stored

#: Labelled rows that a fit uses at most: those with the smallest hash of their id.
SAMPLE_ROWS = 20_000
#: Lasso penalties to choose from, the greatest first.
PENALTIES = (1e-2, 3e-3, 1e-3, 3e-4, 1e-4, 3e-5)
FEATURES = ["log_words", "symbols_per_word", "dup_line_share", "repeat_share", "mean_word_chars", "upper_share",
            "short_word_share", "mark_share"]


@dataclass
class Rule:
    """Holds if every (feature, is_above, threshold) does: above the threshold, or at most it."""
    terms: list[tuple[int, bool, float]]
    weight: float = 0.0

    def column(self) -> Column:
        out = F.lit(True)
        for f, above, at in self.terms:
            x = F.col(FEATURES[f])
            out = out & ((x > at) if above else (x <= at))
        return out

    def holds(self, data: np.ndarray) -> np.ndarray:
        """For each row of FEATURES."""
        out = np.ones(len(data), dtype=bool)
        for f, above, at in self.terms:
            out &= (data[:, f] > at) if above else (data[:, f] <= at)
        return out


@dataclass
class Ensemble:
    intercept: float = 0.0
    rules: list[Rule] = field(default_factory=list)

    def score(self) -> Column:
        z = F.lit(float(self.intercept))
        for r in self.rules:
            z = z + F.when(r.column(), r.weight).otherwise(0.0)
        return 1 / (1 + F.exp(-z))

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "Ensemble":
        d = json.loads(text)
        return Ensemble(d["intercept"], [Rule([tuple(t) for t in r["terms"]], r["weight"]) for r in d["rules"]])


def features(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry`` and FEATURES of each row; a share with nothing to divide by is 0, as for an empty text."""
    stats = quality_rules.statistics(docs, text_col, id_col, carry)
    named = quality_rules.ratios(stats) | {"log_words": F.log1p("n_words")}
    return stats.select("doc_id", *carry, *[F.coalesce(named[f], F.lit(0.0)).cast("double").alias(f) for f in FEATURES])


def tree_rules(node, terms: tuple = ()) -> list[Rule]:
    """Every path from the root to a node below it."""
    out = [Rule(sorted(terms))] if terms else []
    if node.getClass().getSimpleName() == "InternalNode":
        split = node.split()
        f, at = int(split.featureIndex()), float(split.threshold())
        out += tree_rules(node.leftChild(), (*terms, (f, False, at)))
        out += tree_rules(node.rightChild(), (*terms, (f, True, at)))
    return out


def _gradient_steps(met: np.ndarray, ones: np.ndarray, n: np.ndarray, penalty: float, at: np.ndarray, steps: int = 400) -> np.ndarray:
    """Accelerated proximal gradient for the lasso logistic loss; the last weight, the intercept, is free.

    ``met`` has a row for each pattern of rules met (and a last column of ones), ``n`` texts show it, ``ones`` of them of label 1.
    """
    total = n.sum()
    size = 4 * total / max(float(np.square(met).sum(axis=1) @ n), 1.0)   # the inverse of a bound on the curvature
    w, y, t = at.copy(), at.copy(), 1.0
    for _ in range(steps):
        grad = met.T @ (n / (1 + np.exp(-np.clip(met @ y, -40, 40))) - ones) / total
        new = y - size * grad
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - size * penalty, 0)
        t, before = (1 + math.sqrt(1 + 4 * t * t)) / 2, t
        y, w = new + (before - 1) / t * (new - w), new
    return w


def _loss(met: np.ndarray, ones: np.ndarray, n: np.ndarray, w: np.ndarray) -> float:
    z = np.clip(met @ w, -40, 40)
    return float((n * np.logaddexp(0, z) - ones * z).sum() / max(n.sum(), 1))


def weigh(met: np.ndarray, label: np.ndarray, check: np.ndarray, penalties: tuple[float, ...] = PENALTIES) -> tuple[np.ndarray, float, float]:
    """(weights, intercept, penalty): the penalty whose fit on the other rows has the least loss on those of ``check``.

    Rows that meet the same rules are counted together, so the work follows the number of different patterns.
    """
    def patterns(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        packed, of = np.unique(np.packbits(met[rows], axis=1), axis=0, return_inverse=True)
        m = np.unpackbits(packed, axis=1, count=met.shape[1]).astype(np.float64)
        return (np.hstack([m, np.ones((len(m), 1))]), np.bincount(of, weights=label[rows], minlength=len(m)), np.bincount(of, minlength=len(m)).astype(np.float64))
    parts = patterns(~check), patterns(check)
    losses, w = [], np.zeros(met.shape[1] + 1)
    for p in penalties:   # from the greatest on, each from the weights of the one before
        w = _gradient_steps(*parts[0], p, w)
        losses.append(_loss(*parts[1], w))
    best, w = int(np.argmin(losses)), np.zeros(met.shape[1] + 1)
    for p in penalties[:best + 1]:
        w = _gradient_steps(*patterns(np.ones(len(label), dtype=bool)), p, w)
    return w[:-1], float(w[-1]), penalties[best]


def fit(labelled: DataFrame, trees: int = 24, depth: int = 3, penalties: tuple[float, ...] = PENALTIES, seed: int = 7) -> Ensemble:
    """An ensemble from rows of FEATURES and ``label`` (0 or 1; NULL labels are left out).

    Every fifth row, in the order of its features, is held back to choose the penalty. The rows are a
    bounded sample (SAMPLE_ROWS) and come to the driver. With one class only, or no rows, the ensemble
    has no rules and gives the share of ones (one half without rows).
    """
    rows = labelled.where(F.col("label").isNotNull()).select(*FEATURES, F.col("label").cast("double").alias("label"))
    data = np.array(sorted(tuple(r) for r in rows.collect()), dtype=np.float64).reshape(-1, len(FEATURES) + 1)
    n, label = len(data), data[:, -1]
    ones = float(label.sum())
    if not n or ones in (0, n):
        share = (ones + 0.5) / (n + 1)
        return Ensemble(math.log(share / (1 - share)))
    vectors = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, minInstancesPerNode=max(2, n // 1000), seed=seed,
                                    featureSubsetStrategy="onethird", subsamplingRate=0.7).fit(vectors)
    rules, seen = [], set()
    for tree in forest._java_obj.trees():
        for r in tree_rules(tree.rootNode()):
            if tuple(r.terms) not in seen:
                seen.add(tuple(r.terms))
                rules.append(r)
    if not rules:
        share = ones / n
        return Ensemble(math.log(share / (1 - share)))
    met = np.stack([r.holds(data) for r in rules], axis=1)
    weights, intercept, _ = weigh(met, label, np.arange(n) % 5 == 0, penalties)
    return Ensemble(intercept, [Rule(r.terms, float(w)) for r, w in zip(rules, weights) if w])


def sample(labelled: DataFrame, rows: int) -> DataFrame:
    return labelled.orderBy(F.xxhash64("doc_id"), *FEATURES).limit(rows)


def train(feats: DataFrame, labels: DataFrame, usable: Column, label_col: str = "quality",
          sample_rows: int = SAMPLE_ROWS) -> Ensemble:
    """Fit on the labelled rows of ``feats`` where ``usable`` holds, at most ``sample_rows`` of them.

    Several labels of one id count as their rounded mean; labels without an id or value are left out.
    """
    known = (labels.select("doc_id", F.col(label_col).alias("l")).where(F.col("doc_id").isNotNull() & F.col("l").isNotNull())
             .groupBy("doc_id").agg((F.avg("l") >= 0.5).cast("int").alias("label")))
    return fit(stored(sample(feats.where(usable).join(known, "doc_id"), sample_rows), "quality-sample"))


def scored(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text_col: str = "text", id_col: str = "doc_id",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, ``carry``, held_out, score, predicted for each row of ``docs``."""
    feats = stored(features(docs, text_col, id_col, carry), "quality-features")
    held_out = held_out_bucket(F.col("doc_id"), 4) == 2
    model = train(feats, labels, ~held_out)
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), model.score()))
    return (feats.select("doc_id", *carry, held_out.alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= threshold).cast("int")))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, text_col: str = "text",
                   id_col: str = "doc_id") -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Labels of held-out ids (crc32 of the id as text, modulo 4, is 2) are never learned from.
    Every row is scored, empty and NULL texts too, from statistics of its whole text alone;
    repeated rows and NULL ids keep their rows, other columns are not read.
    """
    return scored(docs, labels, threshold, text_col, id_col)
