"""Benchmark decontamination with one FM-index per shard of the corpus.

A task gathers documents into shards of a bounded number of words. A shard's words are
numbered by the test phrases' vocabulary; every run of other words is one separator, since
no phrase can cross it. The shard is then indexed (suffix order, Burrows-Wheeler transform,
wavelet matrix, sampled positions), all phrases are searched backwards at once, their
occurrences are located through the sampled positions, and the spans are merged per document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_bytes, select_ids, small_batches

WINDOW = 10
#: Words of a shard, and the distance of its sampled positions.
SHARD_WORDS, SAMPLE = 1 << 19, 16
#: Text of the test phrases that one pass over the corpus takes along.
BLOCK_BYTES = 8 << 20

#: A-Z to a-z; all other ASCII but 0-9 and a-z separates words; bytes of longer characters are word bytes.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


# ---- the index -------------------------------------------------------------------------

def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; each separator (0) is a symbol of its own, ordered by position."""
    n = len(symbols)
    rank = np.where(symbols == 0, np.arange(n), symbols.astype(np.int64) + n)
    order = np.argsort(rank, kind="stable")
    placed = rank[order]
    first = np.concatenate(([True], placed[1:] != placed[:-1]))
    starts = np.flatnonzero(first)
    group = np.repeat(starts, np.diff(np.append(starts, n)))
    rank = np.empty(n, np.uint64)
    rank[order] = group
    slots = np.flatnonzero(~(first & np.append(first[1:], True)))
    step, bits = 1, np.uint64(21)
    mask = np.uint64((1 << 21) - 1)
    while len(slots):
        at = order[slots].astype(np.uint64)
        after = at + np.uint64(step)
        # a suffix of the last symbols ends before any other
        second = np.where(after < n, rank[np.minimum(after, np.uint64(n - 1)).astype(np.int64)] + np.uint64(1), 0)
        key = (rank[at.astype(np.int64)] << (bits + bits)) | (second.astype(np.uint64) << bits) | at
        key.sort()
        at = (key & mask).astype(np.int64)
        key >>= bits
        first = np.concatenate(([True], key[1:] != key[:-1]))
        starts = np.flatnonzero(first)
        sizes = np.diff(np.append(starts, len(slots)))
        order[slots] = at
        rank[at] = np.repeat(slots[starts], sizes).astype(np.uint64)
        slots = slots[np.repeat(sizes > 1, sizes)]
        step *= 2
    return order


class Bits:
    """A bit vector with rank: packed words and the count of ones before each."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(-len(packed) % 8 + 8, np.uint8))).view(np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(ones[:-1], dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = (np.uint64(1) << bit) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, largest: int):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in reversed(range(max(1, int(largest).bit_length()))):
            bits = ((symbols >> shift) & 1).astype(bool)
            self.levels.append((shift, Bits(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate((symbols[~bits], symbols[bits]))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position, up to the symbol's own offset."""
        for shift, bits, zeros in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> shift) & 1, zeros + ones, at - ones)
        return at

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and its rank there up to the symbol's offset."""
        symbol = np.zeros(len(at), np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits.get(at), bits.rank(at)
            symbol |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at


class FMIndex:
    def __init__(self, symbols: np.ndarray, largest: int, sample: int = SAMPLE):
        order = suffix_order(symbols)
        bwt = symbols[order - 1]  # the symbol before position 0 is the last one, a separator
        self.wavelet = WaveletMatrix(bwt, largest)
        counts = np.bincount(symbols, minlength=largest + 1)
        # rows whose suffix starts with the symbol, less the symbol's own offset in the wavelet matrix
        every = np.arange(largest + 1)
        self.base = np.concatenate(([0], np.cumsum(counts)[:-1])) - self.wavelet.rank(every, np.zeros(largest + 1, np.int64))
        kept = (order % sample == 0) | (bwt == 0)
        self.sampled, self.positions, self.n = Bits(kept), order[kept], len(symbols)

    def search(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Backward search of right-aligned phrases: indices of those that occur, first and last row."""
        live = np.arange(len(phrases))
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n)
        width = phrases.shape[1]
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for step in range(1, width + 1):
            symbol = phrases[live, width - step]
            low = self.base[symbol] + self.wavelet.rank(symbol, low)
            high = self.base[symbol] + self.wavelet.rank(symbol, high)
            found = high > low
            ended = found & (lengths[live] == step)
            done.append((live[ended], low[ended], high[ended]))
            on = found & ~ended
            live, low, high = live[on], low[on], high[on]
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffix rows: walk back to a sampled row, then add the steps taken."""
        out = np.empty(len(rows), np.int64)
        which, steps = np.arange(len(rows)), 0
        while len(which):
            hit = self.sampled.get(rows)
            out[which[hit]] = self.positions[self.sampled.rank(rows[hit])] + steps
            which, rows = which[~hit], rows[~hit]
            symbol, at = self.wavelet.access(rows)
            rows = self.base[symbol] + at
            steps += 1
        return out


# ---- phrases ---------------------------------------------------------------------------

@dataclass
class Phrases:
    """Test phrases by vocabulary number, right-aligned, and the items that hold each."""

    number: dict[bytes, int]
    table: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]

    @staticmethod
    def of(rows: list[tuple[object, bytes]], window: int = WINDOW) -> Phrases:
        owners: dict[tuple[bytes, ...], set[str]] = {}
        for item, text in rows:
            w = words(text)
            for i in range(max(1, len(w) - window + 1) if w else 0):
                owners.setdefault(tuple(w[i: i + window]), set()).add(str(item))
        number: dict[bytes, int] = {}
        for phrase in owners:
            for word in phrase:
                number.setdefault(word, len(number) + 1)
        table = np.zeros((len(owners), window), np.int64)
        for row, phrase in enumerate(owners):
            table[row, window - len(phrase):] = [number[w] for w in phrase]
        lengths = np.array([len(p) for p in owners], np.int64)
        return Phrases(number, table, lengths, [sorted(x) for x in owners.values()])


def occurrences(phrases: Phrases, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, word position and phrase of every occurrence in a shard of numbered texts."""
    empty = np.empty(0, np.int64)
    if not texts or not len(phrases.table):
        return empty, empty, empty
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    flat = np.zeros(starts[-1], np.int64)
    for start, text in zip(starts, texts):
        flat[start: start + len(text)] = text
    kept = np.flatnonzero((flat > 0) | (np.append(flat[1:], 0) > 0) | (np.arange(len(flat)) == len(flat) - 1))
    kept = kept[(flat[kept] > 0) | (np.append(True, flat[kept][:-1] > 0)) | (kept == kept[-1])]
    symbols = flat[kept]
    if not symbols.any():
        return empty, empty, empty
    index = FMIndex(symbols, len(phrases.number))
    phrase, low, high = index.search(phrases.table, phrases.lengths)
    sizes = high - low
    rows = np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = kept[index.locate(rows)]
    text = np.searchsorted(starts, at, side="right") - 1
    return text, at - starts[text], np.repeat(phrase, sizes)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ``[first, past)`` spans as one."""
    out: list[tuple[int, int]] = []
    for first, past in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], past))
        else:
            out.append((first, past))
    return out


def search_texts(phrases: Phrases, texts: list[bytes], shard_words: int = SHARD_WORDS,
                 window: int = WINDOW) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
    """Words, merged spans and items found of each text. A text longer than a shard is cut with overlap."""
    out: list[tuple[int, list[tuple[int, int]], set[str]]] = []
    shard: list[tuple[int, int, np.ndarray]] = []
    size = 0

    def flush() -> None:
        nonlocal size
        which, at, phrase = occurrences(phrases, [x[2] for x in shard])
        for w, a, p in zip(which.tolist(), at.tolist(), phrase.tolist()):
            doc, offset, _ = shard[w]
            out[doc][1].append((offset + a, offset + a + int(phrases.lengths[p])))
            out[doc][2].update(phrases.items[p])
        shard.clear()
        size = 0

    get = phrases.number.get
    for text in texts:
        ids = np.array([get(w, 0) for w in words(text)], np.int64)
        out.append((len(ids), [], set()))
        for offset in range(0, max(1, len(ids) - window + 1), shard_words):
            piece = ids[offset: offset + shard_words + window - 1]
            if size + len(piece) > shard_words:
                flush()
            shard.append((len(out) - 1, offset, piece))
            size += len(piece) + 1
    flush()
    return [(n, merged(spans), items) for n, spans, items in out]


# ---- over tables -----------------------------------------------------------------------

def _blocks(benchmark: DataFrame, block_bytes: int) -> list[Phrases]:
    """The test phrases in blocks of a bounded size; one block for a usual test set."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), as_bytes("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [Phrases.of([(r["item_id"], bytes(r["text"])) for r in items.where(block == i).collect()])
            for i in range(n)]


SPANS = "array<struct<first:int,past:int>>"
FOUND = f"doc_id long, raw long, n_words int, spans {SPANS}, items array<string>"


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES,
                       shard_words: int = SHARD_WORDS) -> DataFrame:
    """``doc_id, n_words, spans, items``: merged word spans of each document that hold test phrases.

    A phrase is ten consecutive words of an item, or all words of a shorter one. Null text and
    items without words have none; a null item id counts as the text ``null``. One row per
    row of ``docs``, repeated and null ids too. An empty benchmark finds nothing.
    """
    return find_in_texts(docs, benchmark, block_bytes, shard_words).drop("raw")


def find_in_texts(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES,
                  shard_words: int = SHARD_WORDS) -> DataFrame:
    """``find_contamination`` with ``raw``, a hash of the row's text as it is."""
    spark = docs.sparkSession
    small_batches(spark)
    kind = pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))
    now = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"), as_bytes("text"), F.lit(0).alias("n_words"),
                      F.array().cast(SPANS).alias("spans"), F.array().cast("array<string>").alias("items"))
    blocks = _blocks(benchmark, block_bytes)
    for i, phrases in enumerate(blocks):
        shared, last = spark.sparkContext.broadcast(phrases), i == len(blocks) - 1

        def search(batches, shared=shared, last=last):
            held: list = []
            size = 0
            for batch in batches:
                held.append(batch)
                size += batch.nbytes
                if size > 6 * shard_words:
                    yield from run(pa.Table.from_batches(held), shared.value, last)
                    held, size = [], 0
            if held:
                yield from run(pa.Table.from_batches(held), shared.value, last)

        def run(table, phrases, last):
            texts = table.column("text").to_pylist()
            found = search_texts(phrases, texts, shard_words)
            spans, items = table.column("spans").to_pylist(), table.column("items").to_pylist()
            columns = [table.column(c).combine_chunks() for c in ("doc_id", "raw")] + ([] if last else [table.column("text").combine_chunks()])
            columns += [pa.array([f[0] for f in found], pa.int32()),
                        pa.array([[{"first": a, "past": b} for a, b in merged(
                            [(x["first"], x["past"]) for x in old] + f[1])] for old, f in zip(spans, found)], kind),
                        pa.array([sorted({*old, *f[2]}) for old, f in zip(items, found)], pa.list_(pa.string()))]
            names = ["doc_id", "raw", *([] if last else ["text"]), "n_words", "spans", "items"]
            yield from pa.table(columns, names).to_batches()

        now = now.mapInArrow(search, FOUND if last else FOUND.replace("n_words", "text binary, n_words"))
    return now


def digest_rows(found: DataFrame) -> DataFrame:
    """The counts and the item digest of each document."""
    hit = F.aggregate("spans", F.lit(0), lambda n, x: n + x["past"] - x["first"])
    return found.select(
        "doc_id", F.col("n_words").cast("long").alias("n_words"), hit.cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the bytes from the first to the last word of each span."""
    flat = text.translate(_TABLE)
    edges = np.diff(np.concatenate(([32], np.frombuffer(flat, np.uint8), [32])).astype(np.int64) != 32, prepend=False)
    at = np.flatnonzero(edges) - 1
    first, past = at[::2], at[1::2]
    out, done = [], 0
    for a, b in spans:
        out.append(text[done: first[a]])
        done = past[b - 1]
    return b"".join([*out, text[done:]])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without any test phrase, with all their columns. A row is judged by its own text, whatever its id."""
    dirty = find_in_texts(docs, benchmark).where(F.size("spans") > 0)
    return select_ids(docs, dirty.select("doc_id", "raw"), "left_anti", raw=True)

