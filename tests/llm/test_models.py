"""Quality rules, language-model scores, toxicity chain, URL filters."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import lm_score, quality, toxicity, url_filter
from tests.llm.helpers import awkward, documents, edited, prose, rows

SF = "/root/testdata/sf0.01"


def accuracy(pairs):
    return sum(a == b for a, b in pairs) / len(pairs)


# ---- quality ---------------------------------------------------------------------------

def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.quality(docs, labels).join(labels, "doc_id").where("held_out")
    pairs = [(r.predicted, r.quality) for r in got.collect()]
    assert len(pairs) > 50 and accuracy(pairs) > 0.95


def test_the_column_is_the_model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    assert model.rules and len(model.rules) < 200
    table = quality.with_statistics(docs).select("doc_id", *quality.STATISTICS, model.column().alias("s")).toPandas()
    x = table[quality.STATISTICS].to_numpy()
    z = model.bias + sum(w * quality.holds(r, x) for r, w in zip(model.rules, model.weights))
    assert np.allclose(1 / (1 + np.exp(-z)), table["s"].to_numpy())


def test_quality_never_learns_from_held_out_rows(spark):
    docs = documents(spark, [(i, prose(i, 30)) for i in range(200)])
    held = quality.held_out(F.col("doc_id"))
    labels = docs.select("doc_id", F.when(held, 0).otherwise(1).alias("quality"))
    assert quality.fit(docs, labels).rules == []  # the learning rows all have one label


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 0), (1, 1), (8, None), (None, 1), (9, 1)], "doc_id long, quality int")
    got = quality.quality(awkward(spark), labels)
    assert got.count() == 13 and got.where("score between 0 and 1 and predicted = int(score >= 0.3)").count() == 13
    assert {r.held_out for r in got.where("doc_id is null").collect()} == {False}
    none = labels.where("doc_id < 0")
    assert [r.score for r in quality.quality(awkward(spark).where("doc_id = 1"), none).collect()] == [0.5, 0.5]
    assert quality.quality(awkward(spark).where("doc_id < 0"), labels).count() == 0


# ---- language models -------------------------------------------------------------------

def brute_scores(pairs, targets):
    """The same models with dictionaries; everything is frequent in so small a corpus."""
    words = {i: (t or "").lower().split() for i, t in pairs}
    out = {}
    for i, w in words.items():
        if not w:
            out[i] = None
            continue
        h = []
        for side in (True, False):
            own = [x for j, x in words.items() if (j in targets) == side]
            n, n2 = Counter(v for x in own for v in x), Counter(p for x in own for p in zip(x, x[1:]))
            if (i in targets) == side:
                n, n2 = n - Counter(w), n2 - Counter(zip(w, w[1:]))
            size = len({v for x in words.values() for v in x}) + 1
            total, loss = sum(n.values()), 0.0
            for k, v in enumerate(w):
                p = 0.95 * (n[v] / total if total else 1 / size) + 0.05 / size
                if k and n[w[k - 1]]:
                    p = 0.7 * n2[w[k - 1], v] / n[w[k - 1]] + 0.3 * p
                loss -= math.log(p)
            h.append(loss / len(w))
        out[i] = h[0] - h[1]
    return out


def test_lm_scores_equal_brute_force(spark):
    pairs = [(i, prose(i, 60, 40 if i % 2 else 60)) for i in range(30)] + [(40, None), (41, ""), (42, "One"), (43, "one ONE")]
    targets = set(range(1, 30, 2))
    ids = spark.createDataFrame([(i,) for i in targets] + [(1,), (None,)], "doc_id long")
    got = {r.doc_id: r.score for r in lm_score.lm_scores(documents(spark, pairs), ids).collect()}
    wanted = brute_scores(pairs, targets)
    assert got.keys() == wanted.keys()
    for i, x in wanted.items():
        assert got[i] == pytest.approx(x, abs=1e-9) if x is not None else got[i] is None


def test_lm_counts_rare_words_of_a_large_corpus(spark):
    pairs = [(i, "filler " * 320_000) for i in range(4)] + [(i, f"{prose(i, 30, 20)} rare couple seen twice") for i in range(4, 8)]
    ids = spark.createDataFrame([(0,), (1,), (4,), (5,)], "doc_id long")
    got = {r.doc_id: r.score for r in lm_score.lm_scores(documents(spark, pairs), ids).collect()}
    assert got == {i: pytest.approx(x, abs=1e-9) for i, x in brute_scores(pairs, {0, 1, 4, 5}).items()}


def test_lm_scores_do_not_depend_on_blocks_and_slices(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 700)
    monkeypatch.setattr(lm_score, "SLICE_BYTES", 300)
    monkeypatch.setattr(lm_score, "BROADCAST_IDS", 3)
    test_lm_scores_equal_brute_force(spark)


def test_lm_counts_survive_packing():
    for keys in ([], [5], [2 ** 63, 2 ** 63 + 1, 2 ** 64 - 1], [0, 3, 2 ** 40]):
        keys = np.array(keys, np.uint64)
        assert (lm_score.unpacked_columns(lm_score.packed_columns(keys, keys // 2), 2, len(keys)) == np.stack((keys, keys // 2))).all()


def test_lm_prefers_its_target(spark):
    pairs = [(i, prose(i, 200, 300) if i < 20 else edited(prose(i, 200, 300), i, 0.5)) for i in range(40)]
    got = lm_score.lm_scores(documents(spark, pairs), spark.createDataFrame([(i,) for i in range(15)], "doc_id long"))
    score = {r.doc_id: r.score for r in got.collect()}
    assert max(score[i] for i in range(15, 20)) < min(score[i] for i in range(20, 40))


def test_lm_awkward_rows(spark):
    none = spark.createDataFrame([], "doc_id long")
    assert lm_score.lm_scores(awkward(spark), none).count() == 13
    assert lm_score.lm_scores(awkward(spark).where("doc_id < 0"), none).count() == 0
    assert lm_score.lm_scores(awkward(spark), none).where("n_tokens = 0 and score is null").count() == 4


# ---- toxicity --------------------------------------------------------------------------

def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    seen, held = labels.where("doc_id % 3 <> 0"), labels.where("doc_id % 3 = 0")
    got = toxicity.toxicity(docs, seen).join(held.withColumnRenamed("toxic", "label"), "doc_id")
    pairs = [(int(r.toxic), r.label) for r in got.collect()]
    assert accuracy(pairs) > 0.95  # some labels here are noise: junk without one telling word
    assert not [p for p in pairs if p == (1, 0)]


def test_chain_feeds_earlier_probabilities():
    r = np.random.default_rng(0)
    lists = [sorted(set(r.integers(0, 20, 5).tolist())) for _ in range(400)]
    first = np.array([float(0 in x or 1 in x) for x in lists])
    second = np.array([float((0 in x or 1 in x) and 2 not in x) for x in lists])
    data = toxicity.Rows.of(lists)
    chain = toxicity.fit_chain({bytes([i]): i for i in range(20)}, data, np.arange(400) % 3, {"a": first, "b": second})
    p = chain.score(data)
    assert accuracy(list(zip(p[:, 0] > 0.5, first > 0.5))) > 0.98 and accuracy(list(zip(p[:, 1] > 0.5, second > 0.5))) > 0.95
    assert len(chain.models[1].earlier) == 1 and chain.models[1].earlier[0] > 0


def test_toxicity_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, None), (None, 1, 1), (9, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.toxicity(awkward(spark), labels).count() == 13
    assert toxicity.toxicity(awkward(spark), labels.where("doc_id < 0")).where("toxic").count() == 0
    assert toxicity.toxicity(awkward(spark).where("doc_id < 0"), labels).count() == 0
    docs = awkward(spark)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 13


# ---- URL filters -----------------------------------------------------------------------

def pages(spark, rows_):
    return spark.createDataFrame([(i, u, h) for i, (u, h) in enumerate(rows_)], "page_id long, url string, html string"
                                 ).withColumns({c: F.lit(1) for c in ("rules", "rule_host", "kind", "rank", "src")})


def test_rules(spark):
    cases = [("http://a.example.net/en/x", "a.example.net", "/en/x", "example.net/en/", "allow"),
             ("https://A.Example.NET/EN/x?q#f", "a.example.net", "/EN/x", "net/", "block"),
             ("http://other.net/", "other.net", "/", "net/", "block"), ("http://other.net", "other.net", "", None, "allow"),
             ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
             ("http://myexample.com/de/", "myexample.com", "/de/", None, "allow"),
             ("http://b.org/fr/1#/de/", "b.org", "/fr/1", "org/fr/", "allow"), ("http://org/fr/", "org", "/fr/", "org/fr/", "allow"),
             ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("x://?a", "", "", None, "allow"),
             ("http://h.io?x=/de/", "h.io", "", None, "allow"), ("a://b://c/d", "b:", "//c/d", None, "allow")]
    got = url_filter.url_filter(pages(spark, [(c[0], None) for c in cases]))
    found = {r.page_id: (r.host, r.path, r.rule) for r in got.collect()}
    assert found == {i: c[1:4] for i, c in enumerate(cases)}
    ruled = {r.page_id: r.verdict for r in got.where("rule is not null").collect()}
    assert ruled == {i: c[4] for i, c in enumerate(cases) if c[3]}


def brute_rank(edges, seeds, rounds=url_filter.ROUNDS):
    out = Counter()
    for (a, _), n in edges.items():
        out[a] += n
    start = {s: 1 / len(seeds) for s in seeds}
    now = dict(start)
    for _ in range(rounds):
        new = Counter({s: 0.15 * x for s, x in start.items()})
        for (a, b), n in edges.items():
            if a in now:
                new[b] += 0.85 * now[a] * n / out[a]
        now = new
    return now


def test_propagation_equals_brute_force(spark):
    link = lambda *hosts: "".join(f'<a class=x href="//{h}/p">l</a><A HREF=\'https://{h}\'>m</A>' for h in hosts)
    sites = {"good.org/fr/": ["mid.io", "far.io"], "bad.net/x": ["other.io"], "spam.io/": ["bad.net", "mid.io"],
             "mid.io/": ["far.io"], "far.io/": ["good.org"], "other.io/": ["Mid.io"], "lone.io/": []}
    got = url_filter.url_filter(pages(spark, [(f"http://{u}", link(*to)) for u, to in sites.items()]))
    edges = Counter()
    for u, to in sites.items():
        for h in to:
            edges[u.split("/")[0], h.lower()] += 2
    trust = brute_rank(edges, ["good.org"])
    distrust = brute_rank({(b, a): n for (a, b), n in edges.items()}, ["bad.net"])
    for r in got.collect():
        assert r.trust == pytest.approx(trust.get(r.host, 0.0)) and r.distrust == pytest.approx(distrust.get(r.host, 0.0))
        if r.rule is None:
            assert r.verdict == ("block" if r.distrust > r.trust else "allow")
    verdicts = {r.host: r.verdict for r in got.collect()}
    assert verdicts["spam.io"] == "block" and verdicts["lone.io"] == "allow" and verdicts["mid.io"] == "allow"


def test_distrust_reaches_hosts_far_from_its_seed(spark):
    edges = spark.createDataFrame([("distrust", f"h{i}", f"h{i + 1}", 1) for i in range(25)],
                                  "kind string, src string, dst string, links long")
    got = {r.host: r.rank for r in url_filter.propagate(edges, spark.createDataFrame([("distrust", "h0")], "kind string, host string")).collect()}
    assert got["h25"] == pytest.approx(0.15 * 0.85 ** 25)


def test_url_filter_plan_has_no_python(spark):
    got = url_filter.url_filter(spark.read.parquet(f"{SF}/pages.parquet"))
    assert "Python" not in got._jdf.queryExecution().toString() and "Arrow" not in got._jdf.queryExecution().toString()
    assert got.count() == 250


def test_url_filter_empty(spark):
    assert url_filter.url_filter(pages(spark, [("x", "y")]).where("page_id < 0")).count() == 0
    assert rows(url_filter.url_filter(pages(spark, [("http://a.net/x", "")] * 2)), "verdict") == [("block",)] * 2
