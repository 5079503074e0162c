"""The Merkle manifest against a plain Merkle tree, and places along an order."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from marketlake.llm import blocks, merkle
from tests.llm.helpers import awkward, documents, rows

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def tree(leaves):
    """Levels of nodes, the leaves first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def climb(levels, at, value):
    siblings = ""
    for level in levels[:-1]:
        first = at - at % 16
        run = level[first:first + 16]
        siblings += "".join(run[:at - first] + run[at - first + 1:])
        value, at = digest("".join(run[:at - first] + [value] + run[at - first + 1:])), at // 16
    return siblings, value


def brute(table):
    sources = {}
    for row in table:
        lowered = row.text and "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text)
        tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0
        sources.setdefault(row.source, []).append((row.doc_id, leaf(row, row.text), leaf(row, lowered if tampered else row.text)))
    trees = {}
    for s, leaves in sources.items():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in leaves])
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for s, leaves in sources.items():
        for i, (doc, original, checked) in enumerate(leaves):
            below, value = climb(trees[s], i, checked)
            above, value = climb(top, names.index(s), value)
            out.append((doc, original, trees[s][-1][0], top[-1][0], digest(below + above), value, value == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("sources", [1, 3, 40])
def test_manifest_equals_a_plain_tree(spark, sources):
    table = documents(spark, [(i, f"Text {i} é", f"s{(i * i) % sources}") for i in range(330)])
    assert rows(merkle.merkle_manifest(table.repartition(5)), *COLUMNS) == brute(table.collect())


def test_awkward_rows(spark):
    nulls = spark.createDataFrame([(None, None, None, None, None), (None, None, None, None, None), (50, "T", None, "ü", None),
                                   (50, "t", "en", "z", 1), (51, "UP", "en", "only", 2)],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    table = awkward(spark).unionByName(nulls, allowMissingColumns=True)
    for extra in ("tree", "rank", "tie", "place", "block", "children", "run", "altered", "leaf"):
        table = table.withColumn(extra, F.lit("clash"))
    assert rows(merkle.merkle_manifest(table), *COLUMNS) == brute(table.collect())


def test_one_row_and_none(spark):
    one = documents(spark, [(5, "A")])
    assert rows(merkle.merkle_manifest(one), *COLUMNS) == brute(one.collect())
    empty = merkle.merkle_manifest(one.where("doc_id < 0"))
    assert empty.count() == 0 and empty.columns == COLUMNS


def test_proofs_of_some_leaves_take_only_their_part(spark):
    table = documents(spark, [(i, f"t{i}", f"s{i % 2}") for i in range(600)])
    made = merkle.manifest(table)
    asked = made.leaves.where("doc_id in (7, 8, 599)").select("tree", "rank", "doc_id", "digest")
    found = merkle.proofs(made, asked).withColumn("up", merkle.folded(F.col("digest"), F.col("path"))).collect()
    assert sorted(r.doc_id for r in found) == [7, 8, 599] and {r.up for r in found} == {made.root}
    wrong = merkle.proofs(made, asked).withColumn("up", merkle.folded(F.sha2(F.lit("x"), 256), F.col("path")))
    assert wrong.where(F.col("up") == made.root).count() == 0


def test_places_and_running_totals(spark):
    df = spark.range(400).selectExpr("case when id < 300 then 'hot' when id < 350 then null else concat('g', id % 9) end as g",
                                     "(id * 37) % 101 as v", "id").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = blocks.numbered(df, ["g"], [F.col("v")], "test")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    got = placed.collect()
    groups = {}
    for r in got:
        groups.setdefault(r.g, []).append(r)
    for g, members in groups.items():
        members.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in members] == list(range(len(members))) and {r.n for r in members} == {len(members)}
        assert [r.v for r in members] == sorted(r.v for r in members)
    assert placed.where("g = 'hot'").select("block").distinct().count() > 1
    summed = blocks.running(placed, ["g"], "rank", {"s": (F.sum, "v", lambda a, b: a + b)}, "test").collect()
    for r in summed:
        members = groups[r.g]
        assert r.s == sum(m.v for m in members[:r["rank"] + 1]) and r.s_all == sum(m.v for m in members)
