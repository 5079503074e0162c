"""Small documents with every awkward case, and brute-force answers."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

CLASHING = ["keep_id", "group_size", "digest", "raw", "node", "key", "keys", "pattern", "slice", "size", "words", "taken",
            "id", "_id", "n", "host", "path", "rule", "verdict", "blocks", "spans", "items", "target", "score", "toxic",
            "quality", "statistic", "doc", "f"]


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    r = random.Random(seed)
    return " ".join(f"x{r.randrange(10 ** 6)}" if r.random() < share else w for w in text.split())


def documents(spark, rows, clash: bool = True):
    """``(doc_id, text[, source])`` as documents, with extra columns that clash with inner names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("clash") for c in CLASHING}) if clash else df


def awkward(spark):
    long_text = prose(5, 30_000, 50_000)
    return documents(spark, [
        (1, "Hello there World"), (1, "Hello there World"), (2, "hello THERE world"), (3, None), (4, ""), (5, " \n\t "),
        (None, "no id here"), (None, None), (6, long_text), (7, long_text), (8, "ÉCOLE é"), (9, "école é"), (10, "one")])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
