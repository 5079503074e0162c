"""Quality classifier as a sparse ensemble of rules.

Small boosted trees over text statistics supply candidate rules: every path from a root is a
conjunction of thresholds. A lasso logistic regression keeps few of them, and the result is
compiled into one Spark column expression over the statistics, which are columns as well.
Only fitting uses a bounded sample of labelled rows; statistics and scores read every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import WORD, sigmoid

#: Labelled rows to fit on at most: those of the smallest hashes.
SAMPLE_ROWS = 40_000
TREES, DEPTH, BINS = 40, 3, 32
LASSO = 0.002
THRESHOLD = 0.3


# ---- statistics ------------------------------------------------------------------------

def statistics(text: Column) -> dict[str, Column]:
    """Counts of the text, each from one pass; ratios are built on them."""
    return {
        "n_chars": F.length(text), "n_words": F.regexp_count(text, F.lit(WORD)),
        "n_upper": F.regexp_count(text, F.lit(r"\p{Lu}")), "n_digits": F.regexp_count(text, F.lit(r"\p{Nd}")),
        "n_symbols": F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:!?'\"()-]")),
        "n_ends": F.regexp_count(text, F.lit(r"[.!?](?=\s|$)")), "n_bangs": F.regexp_count(text, F.lit("!")),
        "n_lines": F.regexp_count(text, F.lit("\n")) + 1,
        "n_distinct": F.size(F.array_distinct(F.split(F.lower(text), r"\s+"))),
        "n_distinct_lines": F.size(F.array_distinct(F.split(text, "\n"))),
    }


def ratios() -> dict[str, Column]:
    def per(a: str, b: str) -> Column:
        return F.col(a) / F.greatest(F.col(b), F.lit(1))

    return {
        "words": F.log1p(F.col("n_words").cast("double")), "word_length": per("n_chars", "n_words"),
        "upper": per("n_upper", "n_chars"), "digits": per("n_digits", "n_chars"), "symbols": per("n_symbols", "n_words"),
        "ends": per("n_ends", "n_words"), "bangs": per("n_bangs", "n_words"), "line_words": per("n_words", "n_lines"),
        "distinct": per("n_distinct", "n_words"), "distinct_lines": per("n_distinct_lines", "n_lines"),
    }


STATISTICS = ["words", "word_length", "upper", "digits", "symbols", "ends", "bangs", "line_words", "distinct",
              "distinct_lines"]


def with_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the statistics; null text counts as empty."""
    text = F.coalesce("text", F.lit(""))
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .select("doc_id", *(c.alias(n) for n, c in statistics(F.col("text")).items()))
            .select("doc_id", *(c.cast("double").alias(n) for n, c in ratios().items())))


# ---- rules -----------------------------------------------------------------------------

@dataclass(frozen=True)
class Test:
    """``statistic <= bound``, or its opposite."""

    statistic: int
    bound: float
    below: bool


Rule = tuple[Test, ...]


def _grow(bins: np.ndarray, edges: list[np.ndarray], slope: np.ndarray, weight: np.ndarray, rows: np.ndarray,
          path: Rule, out: np.ndarray, rules: set[Rule], depth: int) -> None:
    """Grow one tree node: record its path as a rule, split on the best gain or set its step."""
    if path:
        rules.add(path)
    total_s, total_w = slope[rows].sum(), weight[rows].sum()
    best = (1e-6, None)
    if depth and len(rows) >= 20:
        for j, cuts in enumerate(edges):
            if not len(cuts):
                continue
            s = np.cumsum(np.bincount(bins[rows, j], slope[rows], len(cuts) + 1))[:-1]
            w = np.cumsum(np.bincount(bins[rows, j], weight[rows], len(cuts) + 1))[:-1]
            gain = s ** 2 / (w + 1) + (total_s - s) ** 2 / (total_w - w + 1) - total_s ** 2 / (total_w + 1)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], (j, k))
    if best[1] is None:
        out[rows] = total_s / (total_w + 1)
        return
    j, k = best[1]
    left = bins[rows, j] <= k
    for side, below in ((left, True), (~left, False)):
        _grow(bins, edges, slope, weight, rows[side], (*path, Test(j, float(edges[j][k]), below)), out, rules, depth - 1)


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of small boosted trees as conjunctions."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    bins = np.column_stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)])
    rules: set[Rule] = set()
    rate = y.mean()
    z = np.full(len(y), np.log(rate / (1 - rate)))
    for _ in range(TREES):
        p, step = sigmoid(z), np.zeros(len(y))
        _grow(bins, edges, y - p, np.maximum(p * (1 - p), 1e-6), np.arange(len(y)), (), step, rules, DEPTH)
        z += 0.3 * step
    simple = {tuple(sorted(set(r), key=lambda t: (t.statistic, t.below, t.bound))) for r in rules}
    return sorted(simple, key=lambda r: (len(r), [(t.statistic, t.bound, t.below) for t in r]))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for t in rule:
        out &= (x[:, t.statistic] <= t.bound) == t.below
    return out


def lasso(r: np.ndarray, y: np.ndarray, penalty: float = LASSO, steps: int = 400) -> tuple[np.ndarray, float]:
    """L1 logistic regression by accelerated proximal steps; the bias is free."""
    n, m = r.shape
    v = np.ones(m) / np.sqrt(max(m, 1))
    for _ in range(20):  # largest eigenvalue, for the step size
        v = r.T @ (r @ v)
        v /= np.linalg.norm(v) + 1e-12
    size = 4 * n / (float(v @ (r.T @ (r @ v))) + n)
    w, b = np.zeros(m), float(np.log(y.mean() / (1 - y.mean())))
    aw, ab, lw, lb = w, b, w, b
    for step in range(steps):
        error = sigmoid(r @ aw + ab) - y
        w = aw - size * (r.T @ error) / n
        w = np.sign(w) * np.maximum(np.abs(w) - size * penalty, 0)
        b = ab - size * error.mean()
        k = step / (step + 3)
        aw, ab, lw, lb = w + k * (w - lw), b + k * (b - lb), w, b
    return w, b


@dataclass
class Ensemble:
    rules: list[Rule]
    weights: list[float]
    bias: float

    def column(self) -> Column:
        """The probability as one expression over the statistic columns."""
        z = F.lit(float(self.bias))
        for rule, weight in zip(self.rules, self.weights):
            test = F.lit(True)
            for t in rule:
                below = F.col(STATISTICS[t.statistic]) <= F.lit(t.bound)
                test = test & (below if t.below else ~below)
            z = z + F.when(test, F.lit(float(weight))).otherwise(0.0)
        return 1 / (1 + F.exp(-z))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Ensemble:
    """Fit on at most ``rows`` labelled documents that are not held out; one label per id.

    Without both labels the score is the labels' mean, or one half without any.
    """
    own = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
           .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min("quality").cast("double").alias("label"))
           .orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sample = texts.join(F.broadcast(own.select("id")), F.col("doc_id") == F.col("id"))  # `rows` rows at most
    table = with_statistics(sample).join(own, F.col("doc_id") == F.col("id")).orderBy(
        "doc_id").select(*STATISTICS, "label").toArrow()
    y = table.column("label").to_numpy()
    if not len(y) or y.min() == y.max():
        rate = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
        return Ensemble([], [], float(np.log(rate / (1 - rate))))
    x = np.column_stack([table.column(c).to_numpy() for c in STATISTICS])
    rules = tree_rules(x, y)
    if not rules:  # too few rows to split
        return Ensemble([], [], float(np.log(y.mean() / (1 - y.mean()))))
    matrix = np.column_stack([holds(r, x) for r in rules]).astype(np.float32)
    weights, bias = lasso(matrix, y)
    kept = np.flatnonzero(np.abs(weights) > 1e-4)
    return Ensemble([rules[i] for i in kept], [float(weights[i]) for i in kept], bias)


def score(docs: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; null and empty texts score by their statistics.

    A null id is never held out.
    """
    return with_statistics(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                                        ensemble.column().alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
