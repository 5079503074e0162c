"""The prefix trie against a trie built turn by turn."""

import hashlib
import random
import re
import zlib

from pyspark.sql import functions as F

from marketlake.llm import conversation_trie
from tests.llm.helpers import rows

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def truncated_mod(c):
    return c - int(c / 20) * 20


def brute(table):
    turns = {}
    for c, turn, role, text in table:
        if c is not None:
            turns.setdefault(c, []).append((turn, role or "", text or ""))
    for own in turns.values():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, sha(f"{len(x[1].encode())}:{x[1]}{x[2]}")))
    nodes = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = [x[1:] for x in turns.get(c - truncated_mod(c), [])[:h] + own[h:]]
        for d in range(len(whole) + 1):
            node = nodes.setdefault(tuple(whole[:d]), {"members": [], "ends": []})
            node["members"].append(c)
            if d == len(whole):
                node["ends"].append(c)
    children = {k: [] for k in nodes}
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    totals = {}
    for k in sorted(nodes, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        below = [totals[x] for x in children[k]]
        totals[k] = (sum(b[0] for b in below) or 1, (len(nodes[k]["members"]) - 1) * words + sum(b[1] for b in below))
    return sorted(((min(n["members"]), len(k), min(nodes[k[:-1]]["members"]) if k else None, len(n["members"]), len(children[k]),
                    *totals[k], sha(",".join(map(str, sorted(n["ends"]))))) for k, n in nodes.items()), key=repr)


def check(spark, table, partitions=4):
    df = spark.createDataFrame(table, SCHEMA).repartition(partitions)
    assert rows(conversation_trie.prefix_trie(df), *COLUMNS) == brute(table)


def test_random_conversations(spark):
    r = random.Random(4)
    table = []
    for c in range(0, 260):
        if c % 20 == 0 and c % 60 == 0:
            continue  # families without their first conversation
        words = random.Random(r.randrange(6))
        for t in range(r.randrange(0, 7)):
            table.append((c, t, "user" if t % 2 == 0 else "assistant", " ".join(words.choice("abc") for _ in range(words.randrange(4)))))
    check(spark, table)


def test_awkward_rows(spark):
    table = [(1, None, None, None), (1, None, "u", "A  b\tc"), (1, 5, "u", ""), (1, 5, "u", ""), (1, 5, "", "u"), (None, 1, "u", "x"),
             (20, 0, "s", "é ü"), (21, 0, "s", "é ü"), (-3, 1, "u", "minus"), (-40, 1, "u", "x"), (-41, 2, "u", "y"), (-41, 1, "u", "x")]
    table += [(c, 0, "u", "only") for c in range(400, 420)]  # turnless ones among them
    table += [(500 + c, t, "u", f"t{t}") for c in range(9) for t in range(c)]  # prefixes of each other
    df = spark.createDataFrame(table, SCHEMA)
    for extra in ("rank", "block", "digest", "words", "k1", "i", "lent", "weight", "depth", "n_convs"):
        df = df.withColumn(extra, F.lit("clash"))
    assert rows(conversation_trie.prefix_trie(df), *COLUMNS) == brute(table)


def test_a_long_conversation_lies_in_many_blocks(spark):
    table = [(7, t, "u", f"t{t % 5} w") for t in range(900)] + [(8, t, "u", f"t{t % 5} w") for t in range(300)]
    table += [(c, 0, "u", "one") for c in range(40, 90)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        check(spark, table)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_many_equal_ones_and_a_flat_trie(spark):
    table = [(c, 0, "u", "same words here") for c in range(10_000, 13_000)]
    table += [(c, 0, "u", f"own {c}") for c in range(20_000, 23_000)]
    check(spark, table)


def test_empty_table(spark):
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
