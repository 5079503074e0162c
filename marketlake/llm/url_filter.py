"""URL filters: host and path rules, and trust and distrust carried along links between hosts.

Trust flows from trusted hosts along links (a page vouches for what it links to); distrust flows
from blocked hosts against them (who links to bad hosts is suspect). Both are personalised
PageRanks over one weighted edge table and advance in the same join. All of it is DataFrame work.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm.common import ascii_lower, stored

#: (verdict, host, path): a rule fits its host and all subdomains if the path starts with its own.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/"))
DAMPING, TOLERANCE = 0.85, 1e-7
#: Rounds after which the tolerance is always met: what both kinds move in a round is at most 4 * DAMPING ** round.
ROUNDS = math.ceil(math.log(TOLERANCE / 4) / math.log(DAMPING)) + 1
#: A host is blocked if its distrust is above its trust by this factor.
MARGIN = 1.0
_LINK = r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.\-]*:)?//([^/?#\"'\s>]+)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host up to the first of ``/ ? #`` with A-Z lower-cased, then path up to ``?`` or ``#``; else both empty."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    entries = [F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("rule_host"), F.lit(p).alias("rule_path"))
               for v, h, p in rules]
    return spark.range(1).select(F.inline(F.array(*entries)))


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that can fit each distinct host, found by joining its domain suffixes."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    found = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    entry = F.struct((F.length("rule_host") + F.length("rule_path")).alias("length"), "rule_host", "rule_path", "verdict")
    return found.groupBy("host").agg(F.collect_set(entry).alias("rules"))


def with_rules(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """``rule`` and ``rule_verdict`` of the longest rule that fits each page, null where none does."""
    of_host = rules_of_hosts(pages.select("host").distinct(), rules)
    fits = F.array_max(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    return pages.join(of_host, "host", "left").withColumn("best", fits).withColumns(
        {"rule": F.concat("best.rule_host", "best.rule_path"), "rule_verdict": F.col("best.verdict")}).drop("best", "rules")


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links`` between different hosts, from absolute links in the html; counted map-side."""
    links = pages.select(F.col("host").alias("src"), F.explode(
        F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), F.lit(1))).alias("dst"))
    return (links.select("src", ascii_lower(F.col("dst")).alias("dst")).where("src <> dst and src <> ''")
            .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("links")))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Personalised PageRank per kind: ``edges (kind, src, dst, links)``, ``seeds (kind, host)`` → ``kind, host, rank``.

    Every round is one join and one sum, stored, so the lineage stays short. Seeds of a kind share one
    unit; hosts that nothing reaches are absent. Without edges the seeds keep their share.
    """
    n = seeds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    start = stored(seeds.join(n, "kind").select("kind", "host", (1 / F.col("n")).alias("rank")), "seeds")
    out = edges.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    moves = stored(edges.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all")).alias("share")),
                   "moves")
    if moves.isEmpty() or start.isEmpty():
        return start
    now = start
    for _ in range(rounds):
        carried = (moves.join(now.select("kind", F.col("host").alias("src"), "rank"), ["kind", "src"])
                   .select("kind", F.col("dst").alias("host"), (DAMPING * F.col("rank") * F.col("share")).alias("rank")))
        kept = start.select("kind", "host", ((1 - DAMPING) * F.col("rank")).alias("rank"))
        new = stored(carried.unionByName(kept).groupBy("kind", "host").agg(F.sum("rank").alias("rank")), "ranks")
        moved = (new.join(now.withColumnRenamed("rank", "old"), ["kind", "host"], "full")
                 .agg(F.sum(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0])
        now = new
        if moved < TOLERANCE:
            break
    return now


def url_filter(pages: DataFrame, rules: DataFrame | None = None, margin: float = MARGIN) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` per row of ``pages``.

    The longest fitting rule decides. Elsewhere the host does: hosts most of whose pages a rule allows are
    trusted seeds, those most of whose pages one blocks are blocked seeds, and a host is blocked if the
    distrust that reaches it is above its trust. Hosts that nothing reaches, null urls and urls without
    ``://`` are allowed. Null html has no links.
    """
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    own = pages.select("page_id", host.alias("host"), path.alias("path"), "html")
    ruled = stored(with_rules(own.drop("html"), rules if rules is not None else rule_table(spark)), "ruled")
    share = lambda v: F.avg(F.coalesce(F.col("rule_verdict") == v, F.lit(False)).cast("int"))
    hosts = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    seeds = hosts.where("allowed > 0.5").select(F.lit("trust").alias("kind"), "host").unionByName(
        hosts.where("blocked > 0.5").select(F.lit("distrust").alias("kind"), "host"))
    edges = host_edges(own)
    edges = stored(edges, "edges")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links"))
    ranks = propagate(both, seeds)
    of = lambda k: F.sum(F.when(F.col("kind") == k, F.col("rank")).otherwise(0.0)).alias(k)
    judged = ranks.groupBy("host").agg(of("trust"), of("distrust"))
    method = F.when(F.col("distrust") > margin * F.col("trust"), "block").otherwise("allow")
    return (ruled.join(judged, "host", "left").fillna(0.0, ["trust", "distrust"])
            .select("page_id", "host", "path", "rule", F.coalesce("rule_verdict", method).alias("verdict"),
                    "trust", "distrust"))
