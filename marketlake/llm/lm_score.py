"""Cross-entropy difference under a target and a background bigram model.

Both models count every word and every pair of words of their whole corpus and share one vocabulary, so no count is
held by the driver or by a single task. Texts are dealt into blocks of bounded size. A block sends each slice of the
keys (hashes of words and pairs) its keys with their counts, a slice adds up what all blocks sent, and answers every
block with the counts of the others, in the order of the block's keys. The block then scores its texts.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_bytes, mix, shingle_hashes, stored

#: Weight of the bigram estimate, and of the uniform one, which makes what neither corpus knows cost the same in both
#: models, however different the corpora are in size.
BIGRAM_WEIGHT, UNIFORM = 0.7, 0.05
#: Target ids up to which they are broadcast (under 20 MB); more are joined by a shuffle.
BROADCAST_IDS = 500_000
#: Bytes of text of a block, and of all texts per slice of keys: a million words, about two million keys. A row counts
#: as so many bytes besides its text.
BLOCK_BYTES, SLICE_BYTES, ROW_BYTES = 6 << 20, 16 << 20, 64

_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Texts hashed at once, so that what hashing holds stays small beside the block.
HASHED = 100

COUNTED = "slice int, block long, n int, counts binary"
ANSWERED = "block long, slice int, words long, t_words long, b_words long, n int, counts binary"
SCORED = "doc_id long, n_tokens long, h_target double, h_background double"


def _word_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key of every word, the text it stands in, the words that end a pair, and the pairs' keys.

    Keys of words are even, those of pairs odd.
    """
    hashes = np.concatenate([shingle_hashes(b" ".join(texts[i: i + HASHED]), 1) for i in range(0, len(texts), HASHED)])
    of = np.repeat(np.arange(len(texts)), [len(x.split()) for x in texts])
    second = np.flatnonzero(of[1:] == of[:-1]) + 1
    return hashes & ~np.uint64(1), of, second, mix(hashes[second - 1] * _STEP + hashes[second]) | np.uint64(1)


def packed_columns(*columns: np.ndarray) -> bytes:
    """Columns of one length, all first bytes of the numbers before all second ones, which compresses well."""
    table = np.stack([c.astype("<u8") for c in columns]).view(np.uint8).reshape(len(columns), -1, 8)
    return pa.compress(np.ascontiguousarray(table.transpose(0, 2, 1)).tobytes(), codec="zstd", asbytes=True)


def unpacked_columns(packed: bytes, columns: int, n: int) -> np.ndarray:
    table = np.frombuffer(pa.decompress(packed, decompressed_size=8 * columns * n, codec="zstd"), np.uint8)
    return np.ascontiguousarray(table.reshape(columns, 8, n).transpose(0, 2, 1)).view("<u8")[..., 0]


def _counter(bits: int):
    """A block's texts → its keys with their counts in both corpora, one row for each slice, empty ones too."""
    slices = 1 << bits
    starts = np.array([s << (64 - bits) for s in range(1, slices)], np.uint64)

    def counted(table: pa.Table) -> pa.Table:
        word, of, second, pair = _word_keys(table.column("text").to_pylist())
        target = table.column("target").to_numpy()
        keys, number = np.unique(np.concatenate((word, pair)), return_inverse=True)
        n = np.bincount(number, minlength=len(keys))
        t = np.bincount(number, target[np.concatenate((of, of[second]))], len(keys)).astype(np.int64)
        places = [0, *np.searchsorted(keys, starts), len(keys)]
        # steps from key to key are smaller numbers than the keys
        packed = [packed_columns(np.diff(keys[a:b], prepend=np.uint64(0)), t[a:b], (n - t)[a:b]) for a, b in zip(places, places[1:])]
        return pa.table({"slice": pa.array(range(slices), pa.int32()),
                         "block": pa.array([table.column("block")[0].as_py()] * slices, pa.int64()),
                         "n": pa.array(np.diff(places), pa.int32()), "counts": pa.array(packed, pa.binary())})

    return counted


def _answered(table: pa.Table) -> pa.Table:
    """What all blocks sent to a slice → for each block, the counts of the other blocks for its keys, and the slice's
    different words and words of both corpora."""
    sent = [unpacked_columns(x, 3, n) for x, n in zip(table.column("counts").to_pylist(), table.column("n").to_pylist())]
    ends = np.cumsum([0, *table.column("n").to_pylist()])
    t, b = (np.concatenate([x[c] for x in sent]) for c in (1, 2))
    keys, number = np.unique(np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in sent]), return_inverse=True)
    all_t, all_b = (np.bincount(number, x, len(keys)).astype(np.uint64) for x in (t, b))
    t, b = all_t[number] - t, all_b[number] - b
    word = keys & np.uint64(1) == 0
    whole = lambda n: pa.array([int(n)] * len(sent), pa.int64())
    return pa.table({
        "block": table.column("block"), "slice": table.column("slice"), "words": whole(word.sum()),
        "t_words": whole(all_t[word].sum()), "b_words": whole(all_b[word].sum()), "n": table.column("n"),
        "counts": pa.array([packed_columns(t[x:y], b[x:y]) for x, y in zip(ends, ends[1:])], pa.binary())})


def _scored(table: pa.Table, answers: pa.Table) -> pa.Table:
    """A block's texts and the answers of all slices → losses; a text's counts are taken out of its own model."""
    texts = table.column("text").to_pylist()
    word, of, second, pair = _word_keys(texts)
    text = np.concatenate((of, of[second]))
    target = table.column("target").to_numpy()
    keys, number = np.unique(np.concatenate((word, pair)), return_inverse=True)
    _, at, times = np.unique(text << 32 | number, return_inverse=True, return_counts=True)
    times, lengths = times[at], np.bincount(of, minlength=len(texts))
    answers = answers.sort_by("slice")
    others = np.concatenate([unpacked_columns(x, 2, n) for x, n in zip(
        answers.column("counts").to_pylist(), answers.column("n").to_pylist())], axis=1).astype(float)
    vocabulary = sum(answers.column("words").to_pylist()) + 1

    def means(side: int, own: np.ndarray) -> pa.Array:
        total = sum(answers.column(("t_words", "b_words")[side]).to_pylist()) - np.where(own, lengths, 0)[of]
        n = (others[side] + np.bincount(number, own[text], len(keys)))[number] - np.where(own[text], times, 0)
        pairs, n = n[len(word):], n[: len(word)]
        share = np.where(total > 0, n / np.maximum(total, 1), 1 / vocabulary)
        p = (1 - UNIFORM) * share + UNIFORM / vocabulary
        before = n[second - 1]
        weight = np.where(before > 0, BIGRAM_WEIGHT, 0.0)
        p[second] = weight / np.maximum(before, 1) * pairs + (1 - weight) * p[second]
        sums = np.bincount(of, -np.log(p), len(texts))
        return pa.array(sums / np.maximum(lengths, 1), pa.float64(), mask=lengths == 0)

    return pa.table({"doc_id": table.column("doc_id"), "n_tokens": pa.array(lengths, pa.int64()),
                     "h_target": means(0, target), "h_background": means(1, ~target)})


def lm_scores(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, h_target, h_background, score`` per row of ``docs``.

    ``target_ids``: the ids of the target corpus; every other document is background. A document is scored
    without its own counts. ``score`` is the mean over words of the target loss less the background loss: lower is closer to the target. Null and
    empty texts have no words and null scores. A null id is background; repeated rows count each.
    """
    ids = target_ids.select(F.col("doc_id").cast("long").alias("_id")).where("_id is not null").distinct().withColumn(
        "target", F.lit(True))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))
    size = texts.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 1
    ids = stored(ids, "targets")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    marked = texts.join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))
    if not few:
        marked = stored(marked, "marked")  # numbered below, so its order has to stay
    # both uses of the blocks share one shuffle
    blocks = marked.withColumn("block", F.monotonically_increasing_id() % math.ceil(size / BLOCK_BYTES)).groupBy("block")
    bits = math.ceil(math.log2(max(1, size / SLICE_BYTES)))
    answers = blocks.applyInArrow(_counter(bits), COUNTED).groupBy("slice").applyInArrow(_answered, ANSWERED)
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(_scored, SCORED).withColumn(
        "score", F.col("h_target") - F.col("h_background"))
