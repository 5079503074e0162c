"""SimHash fingerprints against a plain vote count, the edited texts, and the search against all pairs."""

import hashlib
import math
import random
import re

import xxhash
from pyspark.sql import functions as F

from marketlake.llm import fingerprints as fp
from tests.llm.helpers import awkward, documents, prose, rows

COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near"]


def spark_hash(*values):
    seed = 42
    for v in values:
        data = v.encode() if isinstance(v, str) else (v & (1 << 64) - 1).to_bytes(8, "little")
        if isinstance(v, bool) or (isinstance(v, int) and v < 8):
            data = v.to_bytes(4, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def simhash(text):
    pieces = re.findall(r"[^\x20\x09-\x0D]{1,4}", text.lower()) or [text]
    pieces += pieces[:len(pieces) % 2 == 0]
    terms = [spark_hash(*x) for x in zip(["", "", *pieces], ["", *pieces], pieces)]
    out = ""
    for lane in range(2):
        hashes = [h if lane == 0 else xxhash.xxh64_intdigest(h.to_bytes(8, "little"), xxhash.xxh64_intdigest(lane.to_bytes(4, "little"), 42))
                  for h in terms]
        value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        out += f"{value:016x}"
    return out


def bits_apart(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def like(a, b):
    return max(0.0, math.cos(math.pi * bits_apart(a, b) / 128))


def brute(pairs):
    docs = [(i, t or "") for i, t in pairs]
    docs.sort(key=lambda x: (x[0] is not None, x[0] or 0, hashlib.md5(x[1].encode()).hexdigest()), reverse=True)
    prints = [simhash(t) for _, t in docs]
    out = []
    for k, (i, t) in enumerate(docs):
        after = (k + 1) % len(docs)
        n = len(t) // 3
        edited = t[:len(t) - n] + docs[after][1][:n]
        e = simhash(edited)
        near = sum(bits_apart(prints[k], x) <= fp.RADIUS for x in prints) - 1 if i is not None and i % 20 == 0 else None
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), prints[k], e, round(like(prints[k], e), 9),
                    round(like(prints[k], prints[after]), 9), near))
    return sorted(out, key=repr)


def got(df):
    return sorted(((*r[:5], round(r[5], 9), round(r[6], 9), r[7]) for r in rows(df, *COLUMNS)), key=repr)


def test_every_document_equals_brute_force(spark):
    r = random.Random(3)
    table = [(i, prose(i // 3, r.randrange(1, 80)) + ("" if i % 3 else " é\nÜ more")) for i in range(90)]
    table += [(100 + i, prose(7, 300) + f" {i}") for i in range(30)]
    df = documents(spark, table)
    assert got(fp.fingerprints(df.repartition(4))) == brute(table)


def test_awkward_rows(spark):
    df = awkward(spark).where("coalesce(length(text), 0) < 1000").unionByName(documents(spark, [(20, "same")] * 5 + [(20, "other")]))
    for extra in ("rank", "md5", "next_rank", "need", "to_id", "slot", "sha256", "pieces", "terms", "l0", "v0_0", "copies", "added", "times"):
        df = df.withColumn(extra, F.lit("clash"))
    assert got(fp.fingerprints(df)) == brute([(r.doc_id, r.text) for r in df.collect()])


def test_one_row_none_and_a_very_long_text(spark):
    one = documents(spark, [(40, "Only one")])
    assert got(fp.fingerprints(one)) == brute([(40, "Only one")])
    assert fp.fingerprints(one.where("doc_id < 0")).count() == 0
    long = [(1, prose(1, 40_000, 9000)), (2, "x" * 50_000), (3, " " * 500)]
    assert got(fp.fingerprints(documents(spark, long))) == brute(long)


def test_search_finds_every_print_within_the_radius(spark):
    r = random.Random(9)
    base = [r.getrandbits(128) for _ in range(12)]
    prints = {b ^ sum({1 << r.randrange(128) for _ in range(r.randrange(14))}) for b in base for _ in range(25)}
    table = [(f"{p:032x}", *(int.from_bytes(bytes.fromhex(f"{p:032x}"[16 * i:16 * i + 16]), signed=True) for i in range(2)))
             for p in prints]
    df = spark.createDataFrame(table, "fingerprint string, l0 long, l1 long")
    asked = df.where(F.crc32(F.col("fingerprint").cast("binary")) % 4 == 0)
    names = [x.fingerprint for x in asked.collect()]
    for radius, blocks in ((7, 8), (3, 5), (12, 13), (0, 1)):
        found = rows(fp.search(df, asked, radius, blocks), "fingerprint", "found", "distance")
        assert found == sorted(((a, b[0], bits_apart(a, b[0])) for a in names for b in table if bits_apart(a, b[0]) <= radius), key=repr)


def test_edits_stay_near_and_others_do_not(spark):
    df = documents(spark, [(i, prose(i, 200, 3000)) for i in range(60)])
    found = fp.fingerprints(df).collect()
    assert min(r.near_edited for r in found) > 0.4 and max(r.near_next for r in found) < 0.4
