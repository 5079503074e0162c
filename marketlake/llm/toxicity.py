"""Classifier chains over toxicity categories.

Categories are predicted one after the other by linear models on the words and word
beginnings of a document; each later model also gets the earlier categories' probabilities,
which during training come from models that have not seen the row (out of fold). Fitting
uses a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_bytes, mix, select_ids, sigmoid, small_batches
from marketlake.llm.decontaminate import words

#: Labelled rows to fit on at most (those of the smallest hashes), and features to choose from them.
SAMPLE_ROWS, FEATURES = 30_000, 2048
#: Rows that must hold a feature before it counts, and the G statistic it must reach (one in a thousand by chance is 10.8).
SUPPORT, LEAST_G = 4, 10.8
FOLDS = 3
THRESHOLD = 0.5
PREFIXES = (4, 5, 6)


def features(text: bytes) -> set[bytes]:
    """Distinct words, and distinct word beginnings marked by a star."""
    found = set(words(text))
    return found.union(*({w[:n] + b"*" for w in found if len(w) >= n} for n in PREFIXES))


@dataclass
class Rows:
    """A sparse 0/1 matrix: feature numbers of each row, end to end."""

    flat: np.ndarray
    starts: np.ndarray

    @staticmethod
    def of(lists: list) -> Rows:
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists]) if len(lists) else np.empty(0, np.int64)
        return Rows(flat, np.append(0, np.cumsum(sizes)))

    def take(self, rows: np.ndarray) -> Rows:
        return Rows.of([self.flat[self.starts[r]: self.starts[r + 1]] for r in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        sums = np.append(0.0, np.cumsum(weights[self.flat]))
        return sums[self.starts[1:]] - sums[self.starts[:-1]]

    def transposed_dot(self, values: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.flat, np.repeat(values, np.diff(self.starts)), minlength=width)


@dataclass
class Linear:
    weights: np.ndarray
    earlier: np.ndarray
    bias: float

    def score(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        return sigmoid(rows.dot(self.weights) + earlier @ self.earlier + self.bias)


def fit_linear(rows: Rows, earlier: np.ndarray, y: np.ndarray, width: int, ridge: float = 0.02, steps: int = 400) -> Linear:
    """Ridge logistic regression by accelerated gradient steps scaled to each feature's count."""
    n, m = len(y), earlier.shape[1]
    scale = np.concatenate((rows.transposed_dot(np.ones(n), width), (earlier ** 2).sum(0), [n])) / 4
    # features of a row move together: divide by how many of them a row has
    scale = scale * (np.mean(np.diff(rows.starts)) + m + 1 if n else 1) + ridge
    w = np.zeros(width + m + 1)
    w[-1] = np.log((y.sum() + 1) / (n - y.sum() + 1))
    ahead, last = w.copy(), w
    for step in range(steps):
        p = sigmoid(rows.dot(ahead[:width]) + earlier @ ahead[width:-1] + ahead[-1])
        slope = np.concatenate((rows.transposed_dot(p - y, width), earlier.T @ (p - y), [(p - y).sum()]))
        slope[:-1] += ridge * ahead[:-1]
        w = ahead - slope / scale
        ahead = w + (step / (step + 3)) * (w - last)
        last = w
    return Linear(w[:width], w[width:-1], float(w[-1]))


@dataclass
class Chain:
    """Feature numbers and one linear model per category, in order."""

    number: dict[bytes, int]
    categories: list[str]
    models: list[Linear]

    def score(self, rows: Rows) -> np.ndarray:
        out = np.zeros((len(rows.starts) - 1, 0))
        for model in self.models:
            out = np.column_stack((out, model.score(rows, out)))
        return out


def fit_chain(number: dict[bytes, int], rows: Rows, fold: np.ndarray, labels: dict[str, np.ndarray]) -> Chain:
    """Models in the order of ``labels``; earlier probabilities are out of fold while fitting."""
    width, earlier, models = len(number), np.zeros((len(fold), 0)), []
    for i, y in enumerate(labels.values()):
        models.append(fit_linear(rows, earlier, y, width))
        if i + 1 < len(labels):
            unseen = np.zeros(len(fold))
            for k in range(FOLDS):
                seen, held = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
                if len(seen) and len(held):
                    model = fit_linear(rows.take(seen), earlier[seen], y[seen], width)
                    unseen[held] = model.score(rows.take(held), earlier[held])
            earlier = np.column_stack((earlier, unseen))
    return Chain(number, list(labels), models)


def labelled(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """Texts with a toxic label, at most ``rows`` of them, chosen by the hash of the id; one label per id."""
    own = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
           .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").alias("toxic"))
           .orderBy(F.xxhash64("id"), "id").limit(rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), as_bytes("text"))
    return texts.join(F.broadcast(own), "id")  # `rows` rows at most


def _counted(batches) -> Iterator[pa.RecordBatch]:
    toxic, clean = Counter(), Counter()
    for batch in batches:
        for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            (toxic if label else clean).update(features(text))
    names = list(toxic.keys() | clean.keys())
    for i in range(0, len(names), 50_000):
        part = names[i: i + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array([toxic[x] for x in part], pa.int64()),
                                          pa.array([clean[x] for x in part], pa.int64())], ["feature", "toxic", "clean"])


def choose_features(sample: DataFrame, keep: int = FEATURES) -> tuple[list[bytes], set[bytes]]:
    """The features most telling by the G statistic, and those of them that clean rows never hold."""
    counts = sample.select("text", "toxic").mapInArrow(_counted, "feature binary, toxic long, clean long").groupBy(
        "feature").agg(F.sum("toxic").alias("a"), F.sum("clean").alias("b"))
    totals = sample.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    t, n = float(totals["t"] or 0), float(totals["n"])
    if not 0 < t < n:
        return [], set()
    held = F.col("a") + F.col("b")

    def term(cell, expected):
        return F.when(cell > 0, cell * F.log(cell / expected)).otherwise(0.0)

    g = (term(F.col("a"), held * t / n) + term(F.col("b"), held * (n - t) / n)
         + term(t - F.col("a"), (n - held) * t / n) + term(n - t - F.col("b"), (n - held) * (n - t) / n))
    best = (counts.where(held >= SUPPORT).select("feature", "a", "b", g.alias("g")).where(F.col("g") >= LEAST_G)
            .orderBy(F.desc("g"), "feature").limit(keep).collect())
    return [bytes(r["feature"]) for r in best], {bytes(r["feature"]) for r in best if r["b"] == 0}


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Chain | None:
    """The chain ``severe`` → ``toxic``; none without both toxic and clean labelled rows.

    The labels know ``toxic`` only. ``severe`` marks toxic rows with at least three of the
    features that clean rows never hold.
    """
    small_batches(docs.sparkSession)
    sample = labelled(docs, labels, rows)
    names, telling = choose_features(sample)
    if not names:
        return None
    number = {name: i for i, name in enumerate(names)}
    strong = np.array([name in telling and not name.endswith(b"*") for name in names])
    shared = sample.sparkSession.sparkContext.broadcast(number)

    def numbered(batches):
        for batch in batches:
            found = [sorted(shared.value[f] for f in features(x) & shared.value.keys())
                     for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("toxic"),
                                              pa.array(found, pa.list_(pa.int32()))], ["id", "toxic", "found"])

    got = sample.select("id", F.col("toxic").cast("int").alias("toxic"), "text").mapInArrow(
        numbered, "id long, toxic int, found array<int>").toArrow().sort_by("id")
    lists = got.column("found").to_pylist()
    toxic = np.array(got.column("toxic").to_pylist(), float)
    severe = toxic * np.array([strong[x].sum() >= 3 if x else False for x in lists])
    fold = mod_fold(np.array(got.column("id").to_pylist(), np.int64))
    return fit_chain(number, Rows.of(lists), fold, {"severe": severe, "toxic": toxic})


def mod_fold(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)


def score(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``doc_id, p_severe, p_toxic, toxic`` per row; null and empty texts score by the bias alone.

    Without a chain every probability is 0.
    """
    return score_texts(docs, chain).drop("raw")


def score_texts(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """``score`` with ``raw``, a hash of the row's text as it is."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"), as_bytes("text"))
    if chain is None:
        return ids.select("doc_id", "raw", F.lit(0.0).alias("p_severe"), F.lit(0.0).alias("p_toxic"), F.lit(False).alias("toxic"))
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(chain)

    def scored(batches):
        number = shared.value.number
        known = number.keys()
        for batch in batches:
            found = [[number[f] for f in features(x) & known] for x in batch.column("text").to_pylist()]
            p = shared.value.score(Rows.of(found))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("raw"), pa.array(p[:, 0]),
                                              pa.array(p[:, 1])], ["doc_id", "raw", "p_severe", "p_toxic"])

    return ids.mapInArrow(scored, "doc_id long, raw long, p_severe double, p_toxic double").withColumn(
        "toxic", F.col("p_toxic") >= THRESHOLD)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Probability of each category and the verdict for every row of ``docs``."""
    return score(docs, fit(docs, labels))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the chain does not reject, with all their columns. A row is judged by its own text, whatever its id."""
    return select_ids(docs, score_texts(docs, fit(docs, labels)).where("toxic").select("doc_id", "raw"), "left_anti", raw=True)
