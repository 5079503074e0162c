"""SimHash fingerprints, their likeness, and search within a Hamming radius by permuted block tables.

A text's terms are runs of three pieces, a piece being up to four characters of a word. Every occurrence
of a term votes on 128 bits, for a one or against it as its hash says, so a term weighs as often as it
occurs. Votes are counted two to a long and merge before they shuffle. Everything is column expressions,
joins and aggregates.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.blocks import numbered, on
from marketlake.llm.common import stored

PIECE = r"[^\x20\x09-\x0D]{1,4}"
LANES = 2
BITS = 64 * LANES
#: Bits within which a search finds all fingerprints, and the blocks they are cut into.
RADIUS, BLOCKS = 3, 4
#: Lowest bits of both halves of a long.
_ENDS = (1 << 32) | 1


def votes(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Fingerprints ``l0, l1`` (64 bits each) of ``(keys..., text)``; ``keys`` tell the rows apart.

    A text without words is one term. Pieces even in number are followed by the first one again, so no bit is ever tied.
    """
    none, one = F.array().cast("array<string>"), F.array(F.lit(""))
    # a generator keeps the optimiser from copying the split into each of its uses
    pieces = texts.select(*keys, "text", F.explode(F.array(F.regexp_extract_all(F.lower("text"), F.lit(PIECE), F.lit(0)))).alias("pieces"))
    pieces = pieces.select(*keys, F.explode(F.array(F.when(F.size("pieces") == 0, F.array("text")).otherwise(F.concat(
        "pieces", F.when(F.size("pieces") % 2 == 0, F.slice("pieces", 1, 1)).otherwise(none))))).alias("pieces"))
    runs = F.arrays_zip(F.slice(F.concat(one, one, "pieces"), F.lit(1), F.size("pieces")).alias("a"),
                        F.slice(F.concat(one, "pieces"), F.lit(1), F.size("pieces")).alias("b"), F.col("pieces").alias("c"))
    votes = pieces.select(*keys, F.explode(runs).alias("x")).select(*keys, F.xxhash64("x.a", "x.b", "x.c").alias("h0"))
    votes = votes.withColumns({f"h{lane}": F.xxhash64(F.lit(lane), "h0") for lane in range(1, LANES)})
    counted = votes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *(
        F.sum(F.shiftrightunsigned(f"h{lane}", bit).bitwiseAND(F.lit(_ENDS))).alias(f"v{lane}_{bit}")
        for lane in range(LANES) for bit in range(32)))
    return counted.select(*keys, *(_majority(lane).alias(f"l{lane}") for lane in range(LANES)))


def _majority(lane: int) -> Column:
    """The bits that more than half of the votes set."""
    bits = F.lit(0).cast("long")
    for bit in range(32):
        both = F.col(f"v{lane}_{bit}")
        low, high = both.bitwiseAND(F.lit(0xFFFFFFFF)) * 2 > F.col("n"), F.shiftrightunsigned(both, 32) * 2 > F.col("n")
        bits = bits.bitwiseOR(F.when(low, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long")).bitwiseOR(
            F.when(high, F.shiftleft(F.lit(1 << bit).cast("long"), 32)).otherwise(F.lit(0).cast("long")))
    return bits


def as_text(prefix: str = "l") -> Column:
    return F.lower(F.concat(*(F.lpad(F.hex(f"{prefix}{lane}"), 16, "0") for lane in range(LANES))))


def distance(a: str, b: str) -> Column:
    """Bits that differ between the lanes named ``a0..`` and ``b0..``."""
    return sum((F.bit_count(F.col(f"{a}{i}").bitwiseXOR(F.col(f"{b}{i}"))) for i in range(1, LANES)),
               F.bit_count(F.col(f"{a}0").bitwiseXOR(F.col(f"{b}0"))))


def likeness(a: str, b: str) -> Column:
    """Cosine of the angle that the differing bits stand for, 0 from a right angle on."""
    return F.greatest(F.lit(0.0), F.cos(distance(a, b) * F.pi() / F.lit(BITS)))


# ---- search ----------------------------------------------------------------------------

def _tables(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """A row per table: its blocks' digits in front form the key. Two prints within the radius agree in
    ``blocks - radius`` blocks at least, so they meet in the table of those."""
    edges = [16 * LANES * i // blocks for i in range(blocks + 1)]
    parts = prints.withColumn("parts", F.array(*(F.substring("fingerprint", a + 1, b - a) for a, b in zip(edges, edges[1:]))))
    keys = [F.struct(F.array(*map(F.lit, c)).alias("taken"), F.concat(*(F.col("parts")[i] for i in c)).alias("key"))
            for c in combinations(range(blocks), blocks - radius)]
    return parts.select("*", F.explode(F.array(*keys)).alias("x")).select("*", "x.taken", "x.key").drop("x")


def search(prints: DataFrame, queries: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """``fingerprint, found, distance``: for each distinct query all distinct prints within ``radius`` bits.

    Both sides: ``(fingerprint, l0, l1)``, repeated rows count once. ``radius`` is below ``blocks``, which is 32 at
    most. A pair that meets in several tables is taken from the first, by the blocks that agree.
    """
    lanes = [f"l{i}" for i in range(LANES)]
    index = _tables(prints.select("fingerprint", *lanes).distinct(), radius, blocks).withColumnsRenamed(
        {"fingerprint": "found", "parts": "parts_b"} | {k: f"b{i}" for i, k in enumerate(lanes)})
    asked = _tables(queries.select("fingerprint", *lanes).distinct(), radius, blocks)
    agreeing = F.filter(F.transform("parts", lambda x, i: F.when(x == F.get("parts_b", i), i)), lambda i: i.isNotNull())
    return (asked.join(index, ["taken", "key"]).withColumn("distance", distance("l", "b"))
            .where((F.col("distance") <= radius) & (F.slice(agreeing, 1, blocks - radius) == F.col("taken")))
            .select("fingerprint", "found", "distance"))


# ---- documents -------------------------------------------------------------------------

def neighbours(docs: DataFrame) -> DataFrame:
    """Distinct ``(doc_id, md5)`` with ``rank`` in descending order of doc_id (null last, equal ids by MD5 of the
    text), ``n``, ``copies``, ``n_chars``, ``next_rank`` and the ``need``, id and MD5 of the one before it (``to_*``)."""
    light = stored(docs.select("doc_id", "md5", F.char_length("text").alias("n_chars")), "light")
    ranked = numbered(light.groupBy("doc_id", "md5").agg(F.count(F.lit(1)).alias("copies"), F.max("n_chars").alias("n_chars")),
                      [], [F.col("doc_id").desc_nulls_last(), F.col("md5").desc()], "order").drop("block")
    ranked = ranked.withColumns({"need": F.expr("n_chars div 3"), "next_rank": (F.col("rank") + 1) % F.col("n")})
    before = ranked.select(F.col("next_rank").alias("rank"), F.col("need").alias("to_need"), F.col("doc_id").alias("to_id"),
                           F.col("md5").alias("to_md5"))
    return stored(ranked.join(before, "rank"), "neighbours")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and how alike it is to that and to the next document's.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``, and for ids that 20
    divides ``n_near``: the other documents within RADIUS bits. The edited text ends in the first characters of the
    next document instead of its own last third. Null text is empty. Documents descend by id, null ids last; rows of
    equal id descend by the MD5 of their text, and equal rows follow each other. A single row is its own next one.
    An empty table gives no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("doc_id", F.md5("text").alias("md5"), "text")
    order = neighbours(docs)
    repeats = order.where("copies > 1").limit(1).count() > 0
    here = on(docs.dropDuplicates(["doc_id", "md5"]) if repeats else docs, order, ["doc_id", "md5"])
    added = here.select(F.col("to_id").alias("doc_id"), F.col("to_md5").alias("md5"),
                        F.substring("text", F.lit(1), F.col("to_need")).alias("added"))
    here = on(here, added, ["doc_id", "md5"])
    head = F.substring("text", F.lit(1), F.col("n_chars") - F.col("need"))
    slots = [F.struct(F.lit(0).alias("slot"), F.col("text")),
             F.struct(F.lit(1).alias("slot"), F.concat(head, "added").alias("text"))]
    if repeats:  # the next one of a repeated row is its copy, but for the last
        own = F.struct(F.lit(2).alias("slot"), F.concat(head, F.substring("text", F.lit(1), F.col("need"))).alias("text"))
        slots.append(F.when(F.col("copies") > 1, own))
    texts = here.select("rank", F.explode(F.array(*slots)).alias("x")).where("x is not null").select("rank", "x.slot", "x.text")
    # only the edited text's hash is asked for; it is a key so that it passes the aggregate
    texts = texts.withColumn("sha256", F.when(F.col("slot") > 0, F.sha2("text", 256)).otherwise(""))
    lanes = [f"l{i}" for i in range(LANES)]
    prints = stored(votes(texts, ["rank", "slot", "sha256"]), "fingerprints")

    base = prints.where("slot = 0").select("rank", *lanes)
    edited = prints.where("slot > 0").select("rank", "slot", F.col("sha256").alias("edited_sha256"),
                                             *(F.col(f"l{i}").alias(f"e{i}") for i in range(LANES)))
    after = base.select(F.col("rank").alias("after"), *(F.col(f"l{i}").alias(f"b{i}") for i in range(LANES)))
    facts = order.select("rank", "next_rank", "doc_id", "copies", F.col("n_chars").cast("long").alias("n_chars"))
    out = (facts.join(base, "rank").join(edited, "rank")
           .withColumn("after", F.when(F.col("slot") == 1, F.col("next_rank")).otherwise(F.col("rank"))).join(after, "after")
           .withColumn("times", F.when(F.col("slot") == 1, 1).otherwise(F.col("copies") - 1)))
    out = out.select("doc_id", "n_chars", "edited_sha256", as_text().alias("fingerprint"), as_text("e").alias("edited_fingerprint"),
                     likeness("l", "e").alias("near_edited"), likeness("l", "b").alias("near_next"), *lanes, "times")
    out = stored(out, "documents")
    # copies count as one print with a weight, so that a search never meets them one by one
    weight = out.groupBy("fingerprint", *lanes).agg(F.sum("times").alias("weight"))
    weight = stored(weight, "distinct")
    found = (search(weight, out.where("doc_id % 20 = 0")).join(weight.select(F.col("fingerprint").alias("found"), "weight"), "found")
             .groupBy("fingerprint").agg((F.sum("weight") - 1).alias("n_near")))
    out = out.join(found, "fingerprint", "left").withColumn("n_near", F.when(F.col("doc_id") % 20 == 0, F.col("n_near")))
    if repeats:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near")
