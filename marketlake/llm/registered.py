"""Registered queries of the training-data operators, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (conversation_trie, decontaminate, exact_dedup, fingerprints, html_extract, lm_score, merkle,
                            mixing, near_dedup, quality, substring_dedup, toxicity, url_filter)
from marketlake.llm.common import read
from marketlake.session import ensure_session


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(read(spark, sf_dir, "documents"))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(read(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = read(spark, sf_dir, "labels").where(F.col("quality") == 1)
    return lm_score.lm_scores(read(spark, sf_dir, "documents"), good)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read(spark, sf_dir, "documents"), percent=85)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest_rows(decontaminate.find_contamination(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(read(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.merkle_manifest(read(spark, sf_dir, "documents"))


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = [op1_exact_dedup, op2_url_filters, op3_quality, op4_lm_scoring, op5_mixing, op6_minhash_near_dedup, op7_toxicity,
           op8_decontamination, op9_substring_dedup, op10_html_extraction, op11_merkle_manifest, op12_fingerprints,
           op13_conversation_trie, pipeline]

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, bit by bit."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
            string_split({text}, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
            lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))), 4294967295)"""


def _leaf(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _climb(walk: str, node: str, same: str) -> str:
    """Recursive step of a fold: a run's nodes with the walker's own digest in its place, and the others."""
    return f"""
            SELECT w.id, w.tree, w.lvl + 1, w.r // 16, (w.n + 15) // 16,
                   sha256(string_agg(CASE WHEN k.r = w.r THEN w.cur ELSE k.d END, '' ORDER BY k.r)),
                   w.sib || coalesce(string_agg(k.d, '' ORDER BY k.r) FILTER (WHERE k.r <> w.r), '')
            FROM {walk} w JOIN {node} k ON {same} AND k.lvl = w.lvl AND k.r // 16 = w.r // 16
            WHERE w.n > 1 GROUP BY w.id, w.tree, w.lvl, w.r, w.n, w.sib"""


ORACLES = {
    "op1_exact_dedup": f"""
        WITH d AS (SELECT doc_id, sha256({_LOWER}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op8_decontamination": rf"""
        WITH item AS (
            SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        phrase AS (
            SELECT DISTINCT item_id, w[i:i + 9] AS p FROM (
                SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item WHERE len(w) > 0)),
        doc AS (
            SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        size AS (SELECT DISTINCT len(p) AS n FROM phrase),
        run AS (
            SELECT doc_id, n, i, w[i:i + n - 1] AS p FROM (
                SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)),
        hit AS (SELECT doc_id, item_id, i, n FROM run JOIN phrase USING (p)),
        word AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hit) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_merkle_manifest": f"""
        WITH RECURSIVE part AS (
            SELECT doc_id, source, {_leaf("text")} AS d,
                   CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0
                        THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS t
            FROM documents),
        leaf AS (
            SELECT *, row_number() OVER (ORDER BY source, doc_id) AS id,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS r,
                   count(*) OVER (PARTITION BY source) AS n
            FROM part),
        node AS (
            SELECT source AS tree, 0 AS lvl, r, n, d FROM leaf
            UNION ALL
            SELECT tree, lvl + 1, r // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY r))
            FROM node WHERE n > 1 GROUP BY tree, lvl, r // 16, n),
        sub AS (
            SELECT tree, d, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS r, count(*) OVER () AS n
            FROM node WHERE n = 1),
        top AS (
            SELECT 0 AS lvl, r, n, d FROM sub
            UNION ALL
            SELECT lvl + 1, r // 16, (n + 15) // 16, sha256(string_agg(d, '' ORDER BY r))
            FROM top WHERE n > 1 GROUP BY lvl, r // 16, n),
        walk AS (
            SELECT id, source AS tree, 0 AS lvl, r, n, coalesce(t, d) AS cur, '' AS sib FROM leaf
            UNION ALL {_climb("walk", "node", "k.tree IS NOT DISTINCT FROM w.tree")}),
        climb AS (
            SELECT w.id, w.tree, 0 AS lvl, s.r, s.n, w.cur, w.sib
            FROM walk w JOIN sub s ON s.tree IS NOT DISTINCT FROM w.tree WHERE w.n = 1
            UNION ALL {_climb("climb", "top", "true")})
        SELECT l.doc_id, l.d AS leaf, s.d AS subroot, t.d AS root, sha256(c.sib) AS proof_sha256, c.cur AS folded_root,
               c.cur = t.d AS verified
        FROM leaf l JOIN sub s ON s.tree IS NOT DISTINCT FROM l.source JOIN climb c ON c.id = l.id AND c.n = 1
        JOIN top t ON t.n = 1""",
    "op13_conversation_trie": rf"""
        WITH turns AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                       sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        conv AS (SELECT c, {_crc32("c::VARCHAR")} % 4 AS h FROM (SELECT DISTINCT c FROM turns)),
        turn AS (
            SELECT conv.c, 0 AS own, p, role, text FROM conv JOIN turns t ON t.c = conv.c - conv.c % 20 AND p < h
            UNION ALL SELECT conv.c, 1, p, role, text FROM conv JOIN turns t ON t.c = conv.c AND p >= h),
        whole AS (
            SELECT conv.c, coalesce(l, []) AS l
            FROM conv LEFT JOIN (SELECT c, list(struct_pack(role, text) ORDER BY own, p) AS l FROM turn GROUP BY c) USING (c)),
        node AS (
            SELECT k, d, min(c) AS conv_id, count(*) AS n_convs,
                   CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(k[d].text, '[^\x20\x09-\x0D]+')) END AS words
            FROM (SELECT c, d, l[1:d] AS k FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM whole)) GROUP BY k, d),
        child AS (SELECT k[1:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
        marked AS (SELECT node.*, coalesce(child.n, 0) AS n_children FROM node LEFT JOIN child USING (k)),
        below AS (
            SELECT k[1:a] AS k, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves,
                   sum((n_convs - 1) * words)::BIGINT AS saved_tokens
            FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM marked) GROUP BY ALL),
        stops AS (SELECT l AS k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM whole GROUP BY l)
        SELECT m.conv_id, m.d AS depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves, saved_tokens,
               sha256(coalesce(ids, '')) AS ends_sha256
        FROM marked m JOIN below USING (k) LEFT JOIN stops USING (k)
        LEFT JOIN node up ON m.d > 0 AND up.d = m.d - 1 AND up.k = m.k[1:m.d - 1]""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {q.__name__: lambda spark, sf_dir, q=q: q(ensure_session(spark), sf_dir) for q in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
