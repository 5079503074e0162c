"""Helpers the operators share: tables, scratch copies, bounded batches, connected components."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import shared_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that Arrow hands to Python at once, so that a batch of long texts stays small.
BATCH_ROWS = "500"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write once under the shared folder and read back: cuts lineage, survives lost executors."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Frames stored on the way to a result, of which those that nothing reads any more can go."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folders = spark, {}

    def _names(self, frame: DataFrame) -> set[str]:
        return {file.rsplit("/", 2)[-2] for file in frame.inputFiles()}

    def stored(self, df: DataFrame, purpose: str) -> DataFrame:
        """As ``stored``, in a folder that ``keep`` knows."""
        path = shared_dir(self.spark, purpose)
        self.folders[path.rsplit("/", 1)[1]] = path
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def together(self, frames: list[DataFrame]) -> DataFrame:
        """Stored frames of one schema as one."""
        if len(frames) == 1:
            return frames[0]
        paths = [self.folders[name] for frame in frames for name in sorted(self._names(frame))]
        return self.spark.read.schema(frames[0].schema).parquet(*paths)

    def keep(self, *frames: DataFrame | None) -> None:
        """Delete the folders that none of ``frames`` reads."""
        read = set().union(*(self._names(frame) for frame in frames if frame is not None))
        for name in self.folders.keys() - read:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.folders.pop(name))
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def as_bytes(name: str) -> Column:
    """Text as UTF-8 bytes, null as empty: Python lower-cases and splits bytes by ASCII rules."""
    return F.coalesce(F.col(name), F.lit("")).cast("binary").alias(name)


def select_ids(docs: DataFrame, ids: DataFrame, how: str, raw: bool = False) -> DataFrame:
    """Rows of ``docs`` whose id (and with ``raw`` whose text hash) is among ``ids``, or with ``left_anti`` is not.

    Null ids match null ids. The other side's columns take names that ``docs`` does not have.
    """
    names = {c: f"{c}_" + "x" * max(map(len, docs.columns)) for c in ids.columns}
    ids = ids.withColumnsRenamed(names).distinct()
    same = docs["doc_id"].cast("long").eqNullSafe(ids[names["doc_id"]])
    if raw:
        same = same & (F.xxhash64(docs["text"]) == ids[names["raw"]])
    return docs.join(ids, same, how)


# ---- shingles --------------------------------------------------------------------------

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    found = _POWERS.get(base)
    if found is None or len(found) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        found = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return found


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words in order; a shorter text is one run, no words no run.

    A run hashes as a polynomial over its bytes with single spaces between words,
    so equal runs hash alike wherever they stand.
    """
    flat = b" ".join(text.lower().split())
    if not flat:
        return np.empty(0, np.uint64)
    data = np.frombuffer(flat, np.uint8)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(data * _powers(_BASE, len(data))[: len(data)], out=sums[1:])
    spaces = np.flatnonzero(data == 32)
    starts = np.concatenate(([0], spaces + 1))
    ends = np.concatenate((spaces, [len(data)]))
    k = min(k, len(starts))
    starts, ends = starts[: len(starts) - k + 1], ends[k - 1:]
    return mix((sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts])


# ---- connected components --------------------------------------------------------------

def components(edges: DataFrame, purpose: str) -> DataFrame:
    """``(a, b)`` links between nodes of any ordered type → ``(node, root)``, root the least node.

    Rounds of two steps: neighbours above a node move to the least node they know
    (large star), then the rest point down (small star). Every round is one row per
    link, stored, so neither a long chain nor a huge star meets in one task.
    """
    now = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a <> b").distinct(), purpose)
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(floor, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(floor.select("a", F.col("m").alias("b"))).distinct())
        now = stored(small, purpose)
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
                        F.countDistinct("a").alias("nodes")).first()
        if before == tuple(state) and state["n"] == state["nodes"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = tuple(state)


# ---- bounded model fitting -------------------------------------------------------------

def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def rows_of(batches: Iterable) -> Iterator[tuple]:
    """Rows of Arrow batches as tuples, one column list at a time."""
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns))
