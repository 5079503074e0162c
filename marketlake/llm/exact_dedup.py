"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries find the digests that may fill more than a set share of all rows.
Their true counts and winners are then computed exactly and broadcast, so rows of huge
groups never shuffle; every other digest goes through an ordinary shuffle, where no group
can exceed that share.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import as_bytes, select_ids, small_batches, stored

#: Counters of a summary. Digests above 2 / COUNTERS of all rows are split off; at most so many are broadcast.
COUNTERS = 4096


def text_digests(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``raw``, ``digest``: SHA-256 of the text with A-Z lower-cased; null text is empty text.

    ``raw`` is a short hash of the text as it is.
    """
    def digest(batches):
        for batch in batches:
            out = [hashlib.sha256(x.lower()).digest() for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary())],
                                             ["doc_id", "raw", "digest"])

    small_batches(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"), as_bytes("text"))
    return ids.mapInArrow(digest, "doc_id long, raw long, digest binary")


class Summary:
    """A Misra-Gries summary that takes values in batches."""

    def __init__(self, counters: int):
        self.counters, self.counts, self.seen = counters, {}, 0

    def add(self, values: list, times: list[int] | None = None) -> None:
        for value, n in zip(values, times or [1] * len(values)):
            self.counts[value] = self.counts.get(value, 0) + n
            self.seen += n
        if len(self.counts) > self.counters:
            # one cut by the (counters + 1)-th count stands for that many rounds of decrements
            n = np.fromiter(self.counts.values(), np.int64, len(self.counts))
            cut = int(np.partition(n, len(n) - self.counters - 1)[len(n) - self.counters - 1])
            self.counts = {k: c - cut for k, c in self.counts.items() if c > cut}


def frequent_digests(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Digests that may fill over ``2 / counters`` of the rows; none that does is missed.

    Each partition keeps one summary. A summary undercounts by at most rows / counters, so the
    sum over partitions does too, and at most ``counters`` digests can reach the bar.
    """
    def summarise(batches):
        summary = Summary(counters)
        for batch in batches:
            found = batch.column(0).value_counts()
            summary.add(found.field("values").to_pylist(), found.field("counts").to_pylist())
        if summary.seen:
            keys, counts = [None, *summary.counts], [summary.seen, *summary.counts.values()]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(counts, pa.int64())], ["digest", "n"])

    summed = digests.select("digest").mapInArrow(summarise, "digest binary, n long").groupBy("digest").agg(
        F.sum("n").alias("n"))
    summed = stored(summed, "frequent")
    total = summed.where("digest is null").agg(F.sum("n")).first()[0] or 0
    return summed.where(F.col("digest").isNotNull() & (F.col("n") * counters > total)).select("digest")


def groups(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """Every row's ``doc_id, raw, digest`` with its group's ``keep_id`` and ``group_size``."""
    digests = stored(text_digests(docs), "digests")
    heavy = F.broadcast(stored(frequent_digests(digests, counters), "heavy"))  # at most `counters` rows
    stats = [F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")]
    # counts of the few heavy digests merge map-side, so this shuffle is partitions x heavy digests at most
    winners = stored(digests.join(heavy, "digest").groupBy("digest").agg(*stats), "winners")
    hot = digests.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = (digests.join(heavy, "digest", "left_anti")
            .withColumns({"keep_id": F.max("doc_id").over(group), "group_size": F.count(F.lit(1)).over(group)}))
    return hot.unionByName(rest)


def exact_dedup(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    The row with the largest doc_id of equal texts stays; null ids count as smallest, and a
    group with null ids only keeps ``keep_id`` null and ``kept`` true. Null and empty texts are
    one group. Repeated rows are rows of their group. An empty table gives no rows.
    """
    return groups(docs, counters).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one_each(docs: DataFrame) -> DataFrame:
    """The row of each group that stays, with all its columns; of repeated winner rows one stays."""
    winners = (groups(docs).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
               .groupBy("digest").agg(F.max("keep_id").alias("doc_id"), F.min("raw").alias("raw")).drop("digest"))
    return select_ids(docs, winners, "left_semi", raw=True).dropDuplicates(["doc_id", "text"])
