"""Decontamination, mixing, HTML extraction, and the pipeline."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from marketlake.llm import decontaminate, html_extract, mixing, near_dedup, toxicity
from marketlake.llm.decontaminate import Phrases, words
from tests.llm.helpers import awkward, documents, prose, rows
from tests.side_by_side import compare, connect

SMALL = "/root/testdata/sf0.001"


# ---- decontamination -------------------------------------------------------------------

def brute_hits(text, items):
    w, hit, found = words(text.encode()), set(), set()
    for i, t in items:
        x = words((t or "").encode())
        for j in range(max(1, len(x) - 9) if x else 0):
            phrase = x[j: j + 10]
            for p in range(len(w) - len(phrase) + 1):
                if w[p: p + len(phrase)] == phrase:
                    hit.update(range(p, p + len(phrase)))
                    found.add(str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("seed", range(8))
def test_fm_index_equals_brute_force(seed):
    r = random.Random(seed)
    k = r.choice([2, 4, 15])
    texts = [" ".join(f"w{r.randrange(k)}" for _ in range(r.choice([0, 1, 7, 40, 150]))) for _ in range(10)]
    items = [(i, " ".join(f"w{r.randrange(k)}" for _ in range(r.choice([0, 1, 5, 9, 10, 13])))) for i in range(8)]
    items.append((99, " ".join(texts[3].split()[2:14])))
    found = decontaminate.search_texts(Phrases.of([(i, t.encode()) for i, t in items]), [t.encode() for t in texts],
                                       shard_words=r.choice([25, 90, 1 << 19]))
    for text, (n, spans, got) in zip(texts, found):
        assert (n, sum(b - a for a, b in spans), sorted(got)) == brute_hits(text, items)


def test_suffix_order_and_rank():
    import numpy as np
    r = np.random.default_rng(3)
    s = r.integers(0, 4, 300)
    order = decontaminate.suffix_order(s)
    key = lambda p: [(x, q) if x == 0 else (x + 1, 0) for q, x in enumerate(s.tolist()) if q >= p]
    assert order.tolist() == sorted(range(300), key=key)
    matrix = decontaminate.WaveletMatrix(s, 3)
    for c in range(4):
        at = np.arange(301)
        start = matrix.rank(np.array([c]), np.array([0]))[0]
        assert (matrix.rank(np.full(301, c), at) - start == np.concatenate(([0], np.cumsum(s == c)))).all()


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_contamination_rows(spark, block_bytes):
    items = [(i, prose(300 + i, 25)) for i in range(6)] + [(7, None), (8, ""), (9, "Zebra"), (None, prose(400, 12))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("spans", F.lit(1))
    pairs = [(1, f"{prose(1, 50)} {items[0][1].upper()}! {prose(2, 30)}"), (2, items[1][1].replace(" ", ", ")), (3, "a zebra"),
             (4, prose(301, 9)), (5, None), (6, ""), (6, ""), (None, items[2][1]), (7, f"{items[3][1]} {items[4][1]}"),
             (8, prose(9, 40_000))]
    found = decontaminate.find_contamination(documents(spark, pairs), bench, block_bytes, shard_words=20_000)
    got = rows(decontaminate.digest_rows(found), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    named = [("null" if i is None else i, t) for i, t in items]
    wanted = []
    for i, t in pairs[:-1]:
        n, hit, who = brute_hits(t or "", [(x if x != "null" else "None", y) for x, y in named])
        wanted.append((i, n, hit, len(who), hashlib.sha256(",".join(who).encode()).hexdigest(), hit > 0))
    plain = [x for x in got if x[0] != 8]
    assert sorted(plain, key=repr) == sorted(wanted, key=repr)
    assert [x[1] for x in got if x[0] == 8] == [40_000]


def test_cut_spans_and_drop(spark):
    assert decontaminate.cut_spans("One, two; three four!".encode(), [(1, 3)]) == b"One,  four!"
    bench = spark.createDataFrame([(1, prose(50, 20))], "item_id long, text string")
    docs = documents(spark, [(1, prose(50, 20)), (2, "clean"), (None, "clean"), (3, None)])
    assert sorted((r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()), key=repr) == [2, 3, None]
    none = bench.where("item_id < 0")
    assert decontaminate.drop_contaminated(docs, none).count() == 4
    assert decontaminate.find_contamination(docs.where("doc_id < 0"), bench).count() == 0


# ---- mixing ----------------------------------------------------------------------------

def test_targets():
    got = mixing.source_targets({"a": 100, "b": 1000, "c": 1000, None: 10})
    assert got["a"] == 200 and got[None] == 20  # both full
    assert got["b"] / got["c"] == pytest.approx(2) and sum(got.values()) == pytest.approx(1.5 * 2110)
    assert mixing.source_targets({}) == {} and mixing.source_targets({"a": 0}) == {"a": 0.0}


def test_min_cost_flow_prefers_first_passes():
    flow = mixing.min_cost_flow({("a",): 10, ("a", "b"): 10, ("b",): 10}, {"a": 18, "b": 18})
    into = lambda s: sum(n for (_, t), n in flow.items() if t == s)
    assert (into("a"), into("b")) == (18, 18)
    used = {}
    for (pattern, _), n in flow.items():
        used[pattern] = used.get(pattern, 0) + n
    assert sum(max(0, n - 10) for n in used.values()) == 6  # 36 words out of 30: six repeats and no more


def test_mix_meets_targets(spark):
    pairs = [(i, prose(i, 20 + i % 50), f"s{i % 5}" if i % 7 else None) for i in range(300)]
    docs = documents(spark, pairs)
    got = mixing.mix(docs)
    again = mixing.mix(docs.repartition(7))
    assert rows(got, "doc_id", "taken") == rows(again, "doc_id", "taken")
    by = got.join(docs.select("doc_id", "source"), "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target"), F.sum("size").alias("size"),
        F.max("source_size").alias("source_size"))
    sizes = {r.source: r["size"] for r in by.collect()}
    wanted = mixing.source_targets(sizes)
    for r in by.collect():
        assert r["size"] == r.source_size and r.target == pytest.approx(wanted[r.source]) and abs(r.taken - r.target) <= 1
    assert got.where("taken > 2 * size").count() == 0


def test_overlapping_sources(spark):
    docs = spark.createDataFrame([(i, prose(i, 30), [["a"], ["a", "b"], ["b", "a", None], []][i % 4]) for i in range(80)],
                                 "doc_id long, text string, source array<string>")
    got = mixing.mix(docs)
    taken = got.select(F.explode("copies").alias("c")).groupBy("c.source").agg(F.sum("c.words").alias("n"))
    assert got.count() == 80 and got.where("size(copies) > 2 or taken > 2 * size").count() == 0
    assert got.where("target > 0").count() == 60 and taken.agg(F.sum("n")).first()[0] == got.agg(F.sum("taken")).first()[0]


def test_mix_awkward_rows(spark):
    got = mixing.mix(awkward(spark))
    assert got.count() == 13 and got.where("size = 0 and taken = 0").count() == 4
    assert mixing.mix(awkward(spark).where("doc_id < 0")).count() == 0


# ---- HTML ------------------------------------------------------------------------------

PAGE = ('<!DOCTYPE html><html><head><title>T {i}</title><style>p{{x:1}}</style></head><body><header>Site name</header>'
        '<nav><ul><li><a href="/{i}">menu {i}</a></ul></nav><div class="ad">buy {i}</div><div class="cookie-notice">ok</div>'
        '<article><h1>Head &amp; {i}</h1><p>First   <b>para</b>graph\n {i}<br>more<p>Share this page with friends</p>'
        '<aside>side {i}</aside><form><input>send</form><script>if (a<b) "</p>"</script><p>Last &lt;{i}&gt;</p>'
        '<section class="comments"><p>nice {i}</p></section></article><footer>&copy; {i}</footer>')


def expected(i):
    return f"Head & {i}\n\nFirst paragraph {i} more\n\nLast <{i}>"


def pages(spark, rows_):
    return spark.createDataFrame(rows_, "page_id long, url string, html string").withColumns(
        {c: F.lit(1) for c in ("host", "reference", "blocks", "slot", "text")})


def test_extraction_drops_furniture_and_template(spark):
    made = [(i, f"http://h{i % 2}.com/{i}", PAGE.format(i=i)) for i in range(12)]
    got = {r.page_id: r for r in html_extract.extract(pages(spark, made)).collect()}
    for i in range(12):
        assert got[i].text == expected(i) and got[i].n_chars == len(expected(i)) and got[i].url == made[i][1]


def test_copies_do_not_make_an_article_template(spark):
    made = [(i, "http://h.com/", PAGE.format(i=7)) for i in range(10)]
    got = html_extract.extract(pages(spark, made)).collect()
    assert all("First paragraph 7 more" in r.text for r in got)


def test_alignment_survives_inserted_blocks(spark):
    extra = "<p>Extra one {i}<p>Extra two {i}"
    made = [(i, "http://h.com/", PAGE.format(i=i).replace("<p>First", (extra.format(i=i) if i % 2 else "") + "<p>First"))
            for i in range(20)]
    for r in html_extract.extract(pages(spark, made)).collect():
        assert "Share this page" not in r.text and ("Extra two" in r.text) == bool(r.page_id % 2)


def test_tree_matching_is_optimal():
    def brute(a, b):
        if a.tag != b.tag:
            return 0
        m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children):
            for j, y in enumerate(b.children):
                m[i + 1][j + 1] = max(m[i][j + 1], m[i + 1][j], m[i][j] + brute(x, y))
        return m[-1][-1] + 1

    r = random.Random(0)

    def tree(depth):
        tag = r.choice("bius")
        return f"<{tag}>{''.join(tree(depth - 1) for _ in range(r.randrange(4))) if depth else ''}</{tag}>"

    for _ in range(60):
        a, b = html_extract.parse(tree(3)), html_extract.parse(tree(3))
        aligner = html_extract.Aligner(b)
        assert aligner.score(a, b) == brute(a, b) == len(aligner.slots(a))


@pytest.mark.parametrize("text, wanted", [
    ("", []), ("plain &lt;x&gt; text", ["plain <x> text"]), ("<p>a<p>b", ["a", "b"]), ("<p>cut &am", ["cut &am"]),
    ("<div>a <a href='x>y'>l</a> b</div>", ["a l b"]), ("<p don't>x</p><p>y's</p>", ["x", "y's"]),
    ("<ul><li>a<li>b</ul>c", ["a", "b", "c"]), ("<table><tr><td>x<td>y<tr><td>z</table>", ["x", "y", "z"]),
    ("<script>x", []), ("a<!-- no -->b<!-- end", ["ab"]), ("x<br>y</div></p>z", ["x yz"]), ("&#233;&nbsp;e", ["é e"]),
    ("<main><article>in</article>out</main>", ["in"]), ("<main>in</main>out", ["in"]), ("<p>a</p", ["a"])])
def test_broken_markup(text, wanted):
    assert [t for _, t in html_extract.blocks(html_extract.parse(text))] == wanted


def test_a_notice_in_plain_markup_is_template_however_long(spark):
    notice = "".join(f"<div>{prose(40 + k, 12)}</div>" for k in range(3))
    made = [(i, "http://h.com/", f"<body><div>{notice}</div><div><div>Own line {i}</div></div></body>") for i in range(8)]
    assert {r.text for r in html_extract.extract(pages(spark, made)).collect()} == {f"Own line {i}" for i in range(8)}
    same = [(i, "http://h.com/", f"<body><div>{notice}</div></body>") for i in range(8)]  # nothing tells template from content
    assert all(r.n_chars > 100 for r in html_extract.extract(pages(spark, same)).collect())


def test_class_words_inside_articles_do_not_remove_text(spark):
    body = ('<article><p>First {i}.</p><div class="search-results"><p>Second {i}.</p></div><p class="related">Third {i}.</p>'
            '<p class="hidden-gem ad">Fourth {i}.</p><div class="ad-slot">Buy {i}</div><ul id="comments"><li>Nice {i}</ul></article>')
    made = [(i, "http://h.com/", body.replace("{i}", str(i))) for i in range(6)]
    for r in html_extract.extract(pages(spark, made)).collect():
        assert r.text == "\n\n".join(f"{n} {r.page_id}." for n in ("First", "Second", "Third", "Fourth"))


def test_deep_pages_are_aligned(spark):
    made = [(i, "http://deep.com/", "<div>" * (900 + 7 * i) + f"own {i}" + "</div>" * 5 + f"<p>more {i}") for i in range(4)]
    got = {r.page_id: r.text for r in html_extract.extract(pages(spark, made)).collect()}
    assert got == {i: f"own {i}\n\nmore {i}" for i in range(4)}


def test_long_child_lists_are_aligned_exactly(spark):
    """A constant line between many varying ones gets one slot, however many stand before it."""
    def page(i):
        lines = [f"<p>a {i} {k}</p>" for k in range(500 + 40 * i)] + ["<section><h3>Always</h3></section>"]
        return "<main>" + "".join(lines + [f"<div><i>c {i} {k}</i></div>" for k in range(90 - 10 * i)]) + "</main>"

    made = [(i, "http://long.com/", page(i)) for i in range(6)]
    for r in html_extract.extract(pages(spark, made)).collect():
        assert "Always" not in r.text and r.text.count("\n\n") == 500 + 40 * r.page_id + 90 - 10 * r.page_id - 1


def test_long_pairings_equal_the_full_table():
    import numpy as np
    r = np.random.default_rng(5)
    for _ in range(40):
        table = r.integers(0, 4, (3, 4)) * r.integers(0, 2, (3, 4))
        a, b = r.integers(0, 3, r.integers(0, 30)), r.integers(0, 4, r.integers(0, 30))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1, j + 1] = max(best[i, j + 1], best[i + 1, j], best[i, j] + table[a[i], b[j]])
        found = sorted(html_extract.paired(table, a, b))
        assert sum(table[a[i], b[j]] for i, j in found) == best[-1, -1] and all(table[a[i], b[j]] > 0 for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))


def test_html_awkward_rows(spark):
    long_page = "<p>" + "word " * 200_000 + "</p>" + "<div>" * 3000
    made = [(1, None, None), (2, "http://a/", ""), (None, "http://a/", "<p>x"), (3, "http://a/", long_page), (3, "http://a/", long_page)]
    got = html_extract.extract(pages(spark, made))
    assert rows(got, "page_id", "n_chars") == sorted([(1, 0), (2, 0), (None, 1), (3, 999_999), (3, 999_999)], key=repr)
    assert html_extract.extract(pages(spark, made).where("page_id < 0")).count() == 0


# ---- pipeline and registered queries ---------------------------------------------------

def test_stages_judge_rows_of_shared_ids_by_their_own_text(spark):
    bench = spark.createDataFrame([(1, prose(50, 20))], "item_id long, text string")
    docs = documents(spark, [(None, prose(50, 20)), (None, "clean"), (1, prose(50, 20)), (1, "clean too"), (2, "other")])
    got = rows(decontaminate.drop_contaminated(docs, bench), "doc_id", "text")
    assert got == sorted([(None, "clean"), (1, "clean too"), (2, "other")], key=repr)
    toxic = [(i, f"vile{i % 2} filth scum {prose(i, 20, 60)}") for i in range(40)]
    clean = [(i, prose(i, 20, 60)) for i in range(40, 80)]
    more = [(None, "vile0 filth scum"), (None, prose(200, 20, 60)), (90, "vile1 filth scum"), (90, prose(201, 20, 60))]
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "doc_id long, toxic int")
    got = rows(toxicity.drop_toxic(documents(spark, toxic + clean + more), labels).where("doc_id is null or doc_id = 90"),
               "doc_id", "text")
    assert got == sorted([more[1], more[3]], key=repr)
    a, b, c = prose(1, 200, 10 ** 6), prose(2, 200, 10 ** 6), prose(3, 200, 10 ** 6)
    # null copies of one text stay once, a null copy of document 3 goes, the text of id 5 near document 3 goes, its other stays
    docs = documents(spark, [(None, a), (None, f"{a} x"), (3, b), (None, f"{b} x"), (5, f"{b} y"), (5, c)])
    got = rows(near_dedup.keep_one_each(docs, 80), "doc_id", "text")
    assert len(got) == 3 and (3, b) in got and (5, c) in got and [t[: len(a)] for i, t in got if i is None] == [a]


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, SMALL)
        assert after.columns == docs.columns and set(after.dtypes) == set(docs.dtypes), name
        now = corpus_pipeline.stored(after, name)
    final = corpus_pipeline.STAGES[-1][1](spark, now, SMALL)
    assert final.count() == now.count() < docs.count()
    assert rows(corpus_pipeline.run(spark, SMALL), "doc_id", "taken") == rows(final, "doc_id", "taken")


@pytest.mark.parametrize("stage", [s for s in corpus_pipeline.STAGES], ids=lambda s: s[0])
def test_stages_take_awkward_rows(spark, stage, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert stage[1](spark, awkward(spark), str(tmp_path)).count() >= 8
    assert stage[1](spark, awkward(spark).where("doc_id < 0"), str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op")))
def test_registered_equals_sql(spark, name):
    assert compare(entry.queries()[name](spark, SMALL), connect(SMALL), entry.oracle_sql()[name]) == ""


def test_all_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert {n.split("_")[0] for n in names} == {f"op{i}" for i in range(1, 11)} and "pipeline" in entry.queries()
    assert os.path.exists(corpus_pipeline.__file__)
