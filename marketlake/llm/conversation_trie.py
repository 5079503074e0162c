"""The trie of conversation prefixes by collapsing whole sequences.

Every rebuilt conversation is a sequence of turns; equal ones become one weighted sequence with the
list of the conversations that end there. Sequences that are proper prefixes of others fall away by an
anti-join, what stays are the leaves. Prefixes of the distinct sequences then carry the weights.

A prefix is known by 128 bits: the XOR of two 64-bit hashes of each turn with its place, so its parent's
key follows without a lookup and a long conversation is keyed block by block. What a subtree adds up is
counted where it arises: a node's share stands in the sequence of its smallest member, and totals from
a place to a sequence's end are summed over the sequences through a node. Nothing is emitted per pair
of ancestor and descendant.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import numbered, on, running
from marketlake.llm.common import WORD, stored

#: Conversations of one family, whose first one lends its first turns, and the most turns it lends.
FAMILY, HEADS = 20, 3
#: A node with more than this share of all nodes as children is looked up by broadcast; there are at most so many.
HEAVY = 4096
KEY = ["k1", "k2"]


def heads_taken(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % (HEADS + 1)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: ``conv_id, block, i, digest, words``; ``i`` counts from 0.

    Each conversation has one more row of ``i = -1`` without a digest, so turnless ones are there too.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    sha = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.unhex(F.substring(sha, 1, 32)).alias("digest"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"))
    turns = numbered(stored(turns, "digests"), ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], "turns").drop("turn")
    first = turns.where((F.col("rank") < HEADS) & (F.col("conv_id") % FAMILY == 0)).groupBy(
        F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(F.struct("rank", "digest", "words"))).alias("lent"))
    whole = (turns.where("rank = 0").select("conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
             .join(first, "base", "left")
             .withColumn("lent", F.slice(F.coalesce("lent", F.array().cast("array<struct<rank:bigint,digest:binary,words:bigint>>")),
                                         F.lit(1), heads_taken(F.col("conv_id")).cast("int"))))
    whole = stored(whole.select("conv_id", "lent", F.size("lent").alias("n_lent")), "conversations")
    taken = whole.select("conv_id", F.lit(-1).alias("block"), F.explode("lent").alias("x")).select(
        "conv_id", "block", F.col("x.rank").alias("i"), "x.digest", "x.words")
    top = whole.select("conv_id", F.lit(-2).alias("block"), F.lit(-1).cast("long").alias("i"),
                       F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("words"))
    # one row per block and conversation, so turns of a long one are joined block by block
    pieces = turns.select("block", "conv_id").distinct().join(whole.select("conv_id", "n_lent"), "conv_id")
    own = on(turns, pieces, ["block", "conv_id"]).where(F.col("rank") >= heads_taken(F.col("conv_id"))).select(
        "conv_id", "block", (F.col("rank") - heads_taken(F.col("conv_id")) + F.col("n_lent")).alias("i"), "digest", "words")
    return top.unionByName(taken).unionByName(own)


def end_lists(ends: DataFrame) -> DataFrame:
    """``k1, k2, ends_sha256``: SHA-256 of the ascending ids of the conversations that end at a node.

    A digest has to be fed in order, so one task feeds a node's ids, but as a stream: it holds one batch.
    """
    def feed(batches):
        key = run = None
        for batch in batches:
            done = []
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, b) == key:
                    run.update(b",%d" % conv)
                    continue
                if key:
                    done.append((*key, run.hexdigest()))
                key, run = (a, b), hashlib.sha256(b"%d" % conv)
            yield _rows(done)
        if key:
            yield _rows([(*key, run.hexdigest())])

    def _rows(done):
        a, b, text = zip(*done) if done else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(text, pa.string())],
                                          [*KEY, "ends_sha256"])

    order = [*KEY, "conv_id"]
    return ends.select(*order).repartition(*KEY).sortWithinPartitions(*order).mapInArrow(
        feed, "k1 long, k2 long, ends_sha256 string")


def collapse(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ends ``(k1, k2, depth, conv_id)`` of all conversations, and distinct sequences with weight and least member."""
    ends = stored(turns.groupBy("conv_id").agg(F.bit_xor("t1").alias("k1"), F.bit_xor("t2").alias("k2"),
                                               (F.max("i") + 1).alias("depth")), "ends")
    sequences = ends.groupBy(*KEY, "depth").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("weight"))
    return ends, stored(sequences, "sequences")


def with_parents(nodes: DataFrame, children: DataFrame, n_nodes: int) -> DataFrame:
    """``nodes`` with ``parent_conv_id``; parents of very many children are broadcast, the rest is an ordinary join."""
    ids = nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    heavy = F.broadcast(stored(children.where(F.col("n_children") * HEAVY > n_nodes).drop("n_children").join(
        ids, ["p1", "p2"]), "heavy-parents"))
    light = nodes.join(heavy.drop("parent_conv_id"), ["p1", "p2"], "left_anti").join(ids, ["p1", "p2"], "left")
    return nodes.join(heavy, ["p1", "p2"]).unionByName(light)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node, all long but the digest: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``.

    Turns ascend by ``turn``, null first; turns of equal number (repeated rows too) ascend by the SHA-256 of
    role and text and all stay. Null role or text is empty. Rows without a conv_id belong to no conversation.
    An empty table has no nodes, not even the root.
    """
    turns = rebuilt(conversations)
    place = [F.when(F.col("i") < 0, F.lit(0)).otherwise(F.xxhash64(F.lit(lane), F.col("i"), F.col("digest"))).cast("long")
             for lane in (1, 2)]
    turns = stored(turns.select("conv_id", "block", "i", place[0].alias("t1"), place[1].alias("t2"), "words"), "rebuilt")
    ends, sequences = collapse(turns)

    pieces = turns.select("block", "conv_id").distinct().join(sequences.select("conv_id", "weight"), "conv_id")
    both = lambda a, b: a.bitwiseXOR(b)
    kept = running(on(turns, pieces, ["block", "conv_id"]), ["conv_id"], "i",
                   {"k1": (F.bit_xor, "t1", both), "k2": (F.bit_xor, "t2", both)}, "keys")
    parent = [F.when(F.col("i") >= 0, F.col(k).bitwiseXOR(F.col(t))).alias(p) for k, t, p in (("k1", "t1", "p1"), ("k2", "t2", "p2"))]
    prefixes = stored(kept.select("conv_id", "block", "i", *KEY, *parent, "weight", "words"), "prefixes")

    proper = prefixes.where("i >= 0").select(F.col("p1").alias("k1"), F.col("p2").alias("k2")).distinct()
    leaves = sequences.join(proper, KEY, "left_anti").select(*KEY, F.lit(1).cast("long").alias("leaf"))
    nodes = prefixes.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.max("i").alias("i"), F.sum("weight").alias("n_convs"),
        F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2")).join(leaves, KEY, "left")
    nodes = stored(nodes.withColumns({"leaf": F.coalesce("leaf", F.lit(0)), "saved": (F.col("n_convs") - 1) * F.col("words")}), "nodes")

    shares = prefixes.select("conv_id", "block", "i", *KEY).join(
        nodes.select("conv_id", "i", "leaf", "saved"), ["conv_id", "i"], "left").na.fill(0, ["leaf", "saved"])
    plus = lambda a, b: a + b
    to_end = running(stored(shares, "shares"), ["conv_id"], "i",
                     {"saved_to": (F.sum, "saved", plus), "leaves_to": (F.sum, "leaf", plus)}, "totals")
    sums = to_end.groupBy(*KEY).agg(
        F.sum(F.col("saved_to_all") - F.col("saved_to") + F.col("saved")).alias("saved_tokens"),
        F.sum(F.col("leaves_to_all") - F.col("leaves_to") + F.col("leaf")).alias("n_leaves"))

    children = stored(nodes.where("i >= 0").groupBy("p1", "p2").agg(F.count(F.lit(1)).alias("n_children")), "children")
    out = (nodes.join(sums, KEY).join(end_lists(ends), KEY, "left")
           .join(children.select(F.col("p1").alias("k1"), F.col("p2").alias("k2"), "n_children"), KEY, "left"))
    out = out.withColumns({"depth": F.col("i") + 1, "n_children": F.coalesce("n_children", F.lit(0)),
                           "ends_sha256": F.coalesce("ends_sha256", F.sha2(F.lit(""), 256))})
    return with_parents(stored(out, "trie"), children, nodes.count()).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
