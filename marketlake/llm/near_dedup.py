"""MinHash near-dedup with tensored banding.

A document hashes into two collections of ``SIDE`` small hashes, each of ``ROWS`` minhashes. Every pair
of one hash from either collection is a table key, so ``SIDE * SIDE`` keys of ``2 * ROWS`` minhashes
cost ``2 * SIDE * ROWS`` minhashes, about the square root of what separate bands would take.

Texts with the same shingle set are one node from the start. Tables propose links in two steps:
each node is compared with the least node it meets, which ties most of a large group together in a
number of comparisons linear in its size; what then still meets in a table without being linked is
gathered into families and compared completely, block by block, without writing out pairs.
Links are always confirmed on the full shingle sets.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import as_bytes, components, mix, select_ids, shingle_hashes, small_batches, stored

SHINGLE = 5
SIDE, ROWS = 8, 3
#: Shingles and sets that one block of a family may hold; two blocks meet in a matrix of BLOCK_SETS squared at most.
BLOCK_SHINGLES, BLOCK_SETS = 200_000, 4096
#: Sets of a block whose similarities are looked at together.
SLICE = 256

_SEEDS = mix(np.arange(1, 2 * SIDE * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def table_keys(shingles: np.ndarray) -> np.ndarray:
    """The ``SIDE * SIDE`` table keys of a shingle set."""
    least = np.array([mix(shingles ^ seed).min() for seed in _SEEDS], np.uint64)
    small = np.zeros(2 * SIDE, np.uint64)
    for row in least.reshape(2 * SIDE, ROWS).T:
        small = mix(small * np.uint64(31) + row)
    left, right = small[:SIDE], small[SIDE:]
    pair = np.arange(SIDE * SIDE, dtype=np.uint64)
    return mix(left[:, None] * np.uint64(0x9E3779B97F4A7C15) + right[None, :]).ravel() ^ mix(pair + np.uint64(977))


def shingle_set(text: bytes) -> np.ndarray:
    return np.unique(shingle_hashes(text, SHINGLE))


def set_name(shingles: np.ndarray) -> bytes | None:
    """128 bits that name a shingle set; none for the empty set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def named_sets(docs: DataFrame) -> DataFrame:
    """``doc_id, raw, node, n_shingles, keys`` per row; raw is a hash of the text as it is, node is the name of the shingle set, null if empty."""
    def names(batches):
        for batch in batches:
            sets = [shingle_set(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array([set_name(s) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([table_keys(s).astype(np.int64) if len(s) else [] for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "raw", "node", "n_shingles", "keys"])

    small_batches(docs.sparkSession)
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("raw"), as_bytes("text"))
            .mapInArrow(names, "doc_id long, raw long, node binary, n_shingles long, keys array<long>"))


def sets_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, shingles`` of the given nodes ``(node, doc_id)``, read again from one document each."""
    def sets(batches):
        for batch in batches:
            found = [shingle_set(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_name(s) for s in found], pa.binary()),
                 pa.array([s.astype(np.int64) for s in found], pa.list_(pa.int64()))], ["node", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), as_bytes("text"))
    one = nodes.select(F.col("doc_id").alias("_id")).distinct()
    read = texts.join(one, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    # a repeated doc_id may bring texts of other nodes along; a node read twice counts once
    return (read.mapInArrow(sets, "node binary, shingles array<long>").join(nodes.select("node"), "node", "left_semi")
            .dropDuplicates(["node"]))


def similar(both: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    return 100 * both >= percent * (left + right - both)


def block_links(sides: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between members that are not yet under one root, at most one per member and root met.

    ``sides`` 0 and 1 compare across, 2 compares within. Shared shingles are counted by
    multiplying membership matrices a slice of the shingles at a time.
    """
    sizes = np.array([len(s) for s in sets])
    flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    _, number, times = np.unique(flat, return_inverse=True, return_counts=True)
    shared = times[number] > 1
    dense, number = np.unique(number[shared], return_inverse=True)
    owner = owner[shared]
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    rows = np.flatnonzero(sides != 1)
    columns = np.flatnonzero(sides != 0)
    both = np.zeros((len(rows), len(columns)), np.float32)
    for low in range(0, len(dense), 512):
        a, b = np.searchsorted(number, [low, low + 512])
        part = np.zeros((len(sets), min(512, len(dense) - low)), np.float32)
        part[owner[a:b], number[a:b] - low] = 1
        right = part[columns].T
        for first in range(0, len(rows), SLICE):
            both[first:first + SLICE] += part[rows[first:first + SLICE]] @ right
    # a spanning forest of what was found is enough
    parent = list(range(len(sets)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for first in range(0, len(rows), SLICE):
        here = rows[first:first + SLICE]
        linked = similar(both[first:first + SLICE].astype(np.int64), sizes[here][:, None], sizes[columns][None, :], percent)
        linked &= roots[here][:, None] != roots[columns][None, :]
        for i, j in zip(*np.nonzero(linked)):
            x, y = int(here[i]), int(columns[j])
            if top(x) != top(y):
                parent[top(x)] = top(y)
                out.append((x, y))
    return out


def _families(docs: DataFrame, open_rows: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` among nodes that share an open table entry, found family by family.

    ``open_rows``: ``key, node, root``. Nodes are split by the size of their sets into classes, so
    that only a class and the next can link, and classes into blocks of a bounded number of shingles.
    """
    star = open_rows.groupBy("key").agg(F.min("node").alias("b"))
    family = components(open_rows.join(star, "key").select(F.col("node").alias("a"), "b"), "family")
    rooted = open_rows.select("node", "root").distinct()
    members = (family.withColumnRenamed("root", "family").join(rooted, "node")
               .join(nodes.select("node", "n_shingles"), "node"))
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(100 / percent) + 1e-9).cast("int")
    members = stored(members.withColumn("class", size_class), "members")
    # a root that holds most of a family is not compared with itself
    counts = members.groupBy("family", "root").agg(F.count(F.lit(1)).alias("n"))
    main = counts.groupBy("family").agg(F.max_by("root", F.struct("n", "root")).alias("main"))
    members = members.join(main, "family").withColumn("is_main", (F.col("root") == F.col("main")).cast("int"))
    load = members.groupBy("family", "class", "is_main").agg(
        F.greatest(F.ceil(F.sum("n_shingles") / F.lit(BLOCK_SHINGLES)),
                   F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_SETS))).cast("int").alias("blocks"))
    placed = stored(members.join(load, ["family", "class", "is_main"]).withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), "placed")
    # every block meets itself (unless main), its class and the next one
    parts = stored(load.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks"), "parts")
    x, y = parts.alias("x"), parts.alias("y")
    near = (F.col("y.class") == F.col("x.class")) | (F.col("y.class") == F.col("x.class") + 1)
    rank = lambda s: F.struct(F.col(f"{s}.class"), F.col(f"{s}.is_main"), F.col(f"{s}.block"))
    meets = (x.join(y, (F.col("x.family") == F.col("y.family")) & near & (rank("x") <= rank("y"))
                    & (F.col("x.is_main") + F.col("y.is_main") < 2))
             .select(F.col("x.family").alias("family"), rank("x").alias("x"), rank("y").alias("y"))
             .withColumn("task", F.xxhash64("family", "x", "y")))
    ends = meets.select("family", "task", F.explode(
        F.when(F.col("x") == F.col("y"), F.array(F.struct(F.lit(2).alias("side"), F.col("x").alias("at"))))
        .otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("x").alias("at")),
                           F.struct(F.lit(1).alias("side"), F.col("y").alias("at"))))).alias("end"))
    ends = ends.select("family", "task", F.col("end.side").alias("side"), F.col("end.at.class").alias("class"),
                       F.col("end.at.is_main").alias("is_main"), F.col("end.at.block").alias("block"))
    sets = sets_of(docs, nodes.join(placed.select("node"), "node", "left_semi").select("node", "doc_id"))
    dealt = (placed.join(ends, ["family", "class", "is_main", "block"]).select("task", "side", "node", "root")
             .join(sets, "node"))

    def links(table):
        sides = table.column("side").to_numpy()
        tops = table.column("root").to_pylist()
        names = {t: i for i, t in enumerate(dict.fromkeys(tops))}
        sets = [np.asarray(s, np.int64) for s in table.column("shingles").to_pylist()]
        found = block_links(sides, np.array([names[t] for t in tops]), sets, percent)
        node = table.column("node").to_pylist()
        return pa.table([pa.array([node[i] for i, _ in found], pa.binary()),
                         pa.array([node[j] for _, j in found], pa.binary())], ["a", "b"])

    return dealt.groupBy("task").applyInArrow(links, "a binary, b binary")


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Sets are the distinct runs of five words (a shorter text is one run), links are shared * 100 >=
    percent * union, and components are named by their smallest doc_id. Texts without words and null
    texts are linked with nothing. Rows that repeat an id keep their own text; a component whose ids
    are all null has a null name and is kept. An empty table gives no rows.
    """
    return grouped(docs, percent).drop("raw", "root")


def grouped(docs: DataFrame, percent: int) -> DataFrame:
    """``near_duplicates`` with ``raw``, a hash of the row's text, and ``root``, the component's least node."""
    named = stored(named_sets(docs), "named")
    nodes = stored(named.where(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys")), "nodes")
    table = nodes.select(F.explode("keys").alias("key"), "node")
    least = (table.groupBy("key").agg(F.min("node").alias("pivot"), F.count(F.lit(1)).alias("n"))
             .where("n > 1").drop("n"))
    table = stored(table.join(least, "key"), "tables")
    # first comparisons: every node with the least node it meets
    first = table.groupBy("node").agg(F.min("pivot").alias("pivot")).where("pivot < node")
    sizes = nodes.select("node", "n_shingles")
    first = (first.join(sizes, "node")
             .join(sizes.select(F.col("node").alias("pivot"), F.col("n_shingles").alias("m")), "pivot")
             .where((F.least("n_shingles", "m") * 100) >= (F.greatest("n_shingles", "m") * percent)))
    first = stored(first.select("node", "pivot"), "first")
    wanted = first.select("node").unionByName(first.select(F.col("pivot").alias("node"))).distinct()
    sets = stored(sets_of(docs, nodes.join(wanted, "node", "left_semi").select("node", "doc_id")), "sets")
    both = (first.join(sets, "node").join(sets.select(F.col("node").alias("pivot"), F.col("shingles").alias("other")),
                                          "pivot")
            .withColumn("both", F.size(F.array_intersect("shingles", "other"))))
    union = F.size("shingles") + F.size("other") - F.col("both")
    links = stored(both.where(F.col("both") * 100 >= union * percent).select(
        F.col("node").alias("a"), F.col("pivot").alias("b")), "links")
    tied = components(links, "tied")
    rooted = table.join(tied, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    mixed = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where(
        "low <> high").select("key")
    open_rows = stored(rooted.join(mixed, "key"), "open")
    links = links.unionByName(_families(docs, open_rows, nodes, percent))
    tied = components(links, "linked")
    of_node = nodes.select("node", "doc_id").join(tied, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named_root = of_node.groupBy("root").agg(F.min("doc_id").alias("component"))
    of_node = of_node.join(named_root, "root").select("node", "root", "component")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return (named.drop("keys").join(of_node, "node", "left")
            .select("doc_id", "raw", "root", "n_shingles", component.alias("component_id"),
                    F.col("doc_id").eqNullSafe(component).alias("kept")))


def keep_one_each(docs: DataFrame, percent: int = 85) -> DataFrame:
    """The document of each group that stays, with all its columns.

    Documents without words all stay. Rows that repeat the id and text of a winner stay once; where a group's least
    id, or null as its only one, has several texts, one of them stays. Other texts of a winner's id are judged for themselves.
    """
    kept = stored(grouped(docs, percent).where("kept"), "kept")
    winners = kept.where(F.col("root").isNotNull()).groupBy("root").agg(
        F.min(F.struct("doc_id", "raw")).alias("w")).select("w.doc_id", "w.raw")
    kept = winners.unionByName(kept.where(F.col("root").isNull()).select("doc_id", "raw"))
    return select_ids(docs, kept, "left_semi", raw=True).dropDuplicates(["doc_id", "text"])
