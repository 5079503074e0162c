"""A Merkle manifest of a dataset as a content-addressed DAG, and proofs by descent from its root.

Every document is a leaf; 16 consecutive nodes become one, per source and then over the sources.
A record says which children a digest stands for. Requested leaves descend together: the part of
the path that leaves of one run share exists once, the children not taken are collected on the
way down, and the segments are reversed for the way up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import numbered, on
from marketlake.llm.common import ascii_lower, stored

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:string,after:string>>"
#: Tree of the sources' roots; a tree of a source bears the source's name.
TOP = ""


def leaf_digest(text: Column | None = None) -> Column:
    """SHA-256 of a row's fields: ``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    values = {c: F.col(c) for c in FIELDS} | ({} if text is None else {"text": text})
    parts = []
    for value in values.values():
        value = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


@dataclass
class Dag:
    """Records by height, ``(tree, rank, digest, children)``, and the roots, ``(tree, digest, height)``."""

    records: dict[int, DataFrame]
    roots: DataFrame


def build(leaves: DataFrame, purpose: str) -> Dag:
    """The DAG over ``(tree, rank, n, digest)``: each level's runs are grouped by rank and stored as records."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes, records, roots, height = leaves.select("tree", "rank", "n", "digest"), {}, None, 0
    while True:
        found = nodes.where("n = 1").select("tree", "digest", F.lit(height).alias("height"))
        roots = found if roots is None else roots.unionByName(found)
        if most <= 1:
            return Dag(records, stored(roots, f"{purpose}-roots"))
        most, height = -(-most // FANOUT), height + 1
        run = (nodes.where("n > 1").groupBy("tree", F.expr(f"rank div {FANOUT}").alias("rank"), "n")
               .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("children"))  # 16 at most
               .withColumn("children", F.col("children.digest"))
               .withColumn("digest", F.sha2(F.array_join("children", ""), 256)))
        run = stored(run.withColumn("n", F.ceil(F.col("n") / FANOUT)), f"{purpose}-{height}")
        records[height] = run.select("tree", "rank", "digest", "children")
        nodes = run.select("tree", "rank", "n", "digest")


def _unselected(digit: Column) -> Column:
    """The children beside the one taken, as the text before and after it."""
    children = F.col("children")
    return F.struct(F.array_join(F.slice(children, F.lit(1), digit), "").alias("before"),
                    F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "").alias("after"))


def descend(dag: Dag, starts: DataFrame, requests: DataFrame, purpose: str) -> DataFrame:
    """``requests`` with ``path`` and the columns of ``starts``: the proof of each requested leaf, the root's level first.

    ``starts``: ``(tree, path, ...)``, what lies above each tree's root. ``requests``: ``(tree, rank, ...)``.
    Nodes of one height step down at a time, by joining their digest to the records of that height; the
    next rank digit of a request says which children go on, and the others become a segment of its path.
    The last step is taken by each request itself, so paths are stored once for 16 leaves.
    """
    wanted, asked = {}, requests
    for height in range(1, max(dag.records, default=0)):
        asked = wanted[height] = stored(
            asked.select("tree", F.expr(f"rank div {FANOUT}").alias("rank")).distinct(), f"{purpose}-wanted")
    tops = on(dag.roots.select("tree", "digest", "height"), starts, ["tree"]).withColumn("rank", F.lit(0).cast("long"))
    runs = tops.where("height = 0").withColumn("children", F.array("digest"))
    now = None
    for height in sorted(dag.records, reverse=True):
        here = tops.where(F.col("height") == height)
        # a record is one row however many equal nodes it stands for
        records = dag.records[height].groupBy("digest").agg(F.first("children").alias("children"))
        here = (here if now is None else here.unionByName(now)).join(records, "digest")
        if height == 1:
            runs = runs.unionByName(here)
            break
        step = here.select("*", F.posexplode("children").alias("digit", "child")).withColumns({
            "rank": F.col("rank") * FANOUT + F.col("digit"), "digest": F.col("child"), "height": F.col("height") - 1,
            "path": F.concat("path", F.array(_unselected(F.col("digit"))))}).drop("children", "digit", "child")
        now = stored(on(step, wanted[height - 1], ["tree", "rank"], "left_semi"), f"{purpose}-down")
    digit = F.expr(f"cast(rank % {FANOUT} as int)")
    segment = F.when(F.col("height") > 0, F.array(_unselected(digit))).otherwise(F.array().cast(PATH))
    return (on(requests.withColumn("run", F.expr(f"rank div {FANOUT}")),
               runs.withColumnRenamed("rank", "run").drop("digest"), ["tree", "run"])
            .withColumn("path", F.concat("path", segment)).drop("children", "run", "height"))


@dataclass
class Manifest:
    """Leaves ``(tree, rank, n, digest, doc_id, altered)``, the sources' DAG, the DAG over them and the root."""

    leaves: DataFrame
    sources: Dag
    top: Dag
    root: str | None


def manifest(docs: DataFrame, altered: Column | None = None) -> Manifest:
    """The stored manifest of all documents; ``altered``: another text whose leaf digest goes along (null: none).

    Leaves ascend by doc_id within their source, null ids first; rows of equal id ascend by digest and are
    leaves of their own. Null is a source. An empty table has no leaves, no records and no root.
    """
    other = F.lit(None).cast("string") if altered is None else F.when(altered.isNotNull(), leaf_digest(altered))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").alias("tree"),
                       leaf_digest().alias("digest"), other.alias("altered"))
    leaves = numbered(stored(rows, "leaves"), ["tree"], [F.col("doc_id").asc_nulls_first(), F.col("digest")], "leaf-order")
    sources = build(leaves, "source-dag")
    order = numbered(sources.roots.select(F.col("tree").alias("source"), "digest"), [], [F.col("source").asc_nulls_first()],
                     "source-order").withColumn("tree", F.lit(TOP))
    top = build(order, "top-dag")
    sources.roots = on(sources.roots, order.select("source", F.col("rank").alias("place")).withColumnRenamed("source", "tree"), ["tree"])
    root = top.roots.first()
    return Manifest(leaves, sources, top, root and root["digest"])


def proofs(made: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (``tree, rank, ...``) with ``subroot`` and ``path``, segments from the leaf up to the root."""
    spark = requests.sparkSession
    names = made.sources.roots.select("tree", F.col("digest").alias("subroot"), "place")
    start = spark.range(1).select(F.lit(TOP).alias("tree"), F.array().cast(PATH).alias("path"))
    places = on(names, requests.select("tree").distinct(), ["tree"], "left_semi").withColumnsRenamed(
        {"tree": "source", "place": "rank"}).withColumn("tree", F.lit(TOP))
    above = descend(made.top, start, places, "top").select(F.col("source").alias("tree"), "subroot", "path")
    return descend(made.sources, stored(above, "above"), requests, "source").withColumn("path", F.reverse("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the segments of its path give."""
    return F.aggregate(path, leaf, lambda h, x: F.sha2(F.concat(x["before"], h, x["after"]), 256))


def merkle_manifest(docs: DataFrame) -> DataFrame:
    """Every leaf with its proof checked: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    The texts of documents whose id's CRC-32 five divides are checked with A-Z lower-cased; a null id
    leaves its text as it is. ``verified`` says whether the checked leaf gives the root.
    """
    tampered = F.when(F.crc32(F.col("doc_id").cast("long").cast("string").cast("binary")) % 5 == 0,
                      ascii_lower(F.col("text")))
    made = manifest(docs, tampered)
    found = proofs(made, made.leaves.select("tree", "rank", "doc_id", "digest", "altered"))
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["before"], x["after"])), "")
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", F.lit(made.root).cast("string").alias("root"),
        F.sha2(siblings, 256).alias("proof_sha256"),
        folded(F.coalesce("altered", "digest"), F.col("path")).alias("folded_root")
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
