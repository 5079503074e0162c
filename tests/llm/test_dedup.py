"""Exact, near and substring dedup against brute force, and their awkward cases."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from marketlake.llm import exact_dedup, near_dedup, substring_dedup
from marketlake.llm.common import components, shingle_hashes
from tests.llm.helpers import awkward, documents, edited, prose, rows


def lowered(text):
    return (text or "").encode().lower()


# ---- exact -----------------------------------------------------------------------------

def brute_exact(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(lowered(t), []).append(i)
    best = {t: max(ids, key=lambda x: (x is not None, x or 0)) for t, ids in groups.items()}
    return sorted(((i, best[lowered(t)], len(groups[lowered(t)]), i == best[lowered(t)],
                    hashlib.sha256(lowered(t)).hexdigest()) for i, t in pairs), key=repr)


@pytest.mark.parametrize("counters", [2, 4096])
def test_exact_dedup_equals_brute_force(spark, counters):
    docs = awkward(spark).unionByName(documents(spark, [(100 + i, "Many times") for i in range(40)]))
    pairs = [(r.doc_id, r.text) for r in docs.collect()]
    got = exact_dedup.exact_dedup(docs.repartition(5), counters)
    assert rows(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(pairs)


def test_summary_keeps_every_frequent_value():
    summary = exact_dedup.Summary(10)
    values = [i % 7 if i % 2 else 1000 + i for i in range(5000)]
    for i in range(0, 5000, 100):
        summary.add(values[i: i + 100])
    assert len(summary.counts) <= 10
    for v in range(7):
        n = values.count(v)
        assert n <= 5000 / 11 or n - 5000 / 11 <= summary.counts.get(v, 0) <= n


def test_exact_dedup_keeps_one_row_each_with_all_columns(spark):
    docs = awkward(spark)
    kept = exact_dedup.keep_one_each(docs)
    assert kept.columns == docs.columns
    # É is not lower-cased; ids 1 and 2, 3 and 4 and the null, 6 and 7 are groups
    assert [r.doc_id for r in kept.orderBy("doc_id").collect()] == [None, 2, 4, 5, 7, 8, 9, 10]


def test_empty_tables(spark):
    none = documents(spark, [(1, "x")]).where("doc_id < 0")
    assert exact_dedup.exact_dedup(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0
    assert substring_dedup.repeated_passages(none).count() == 0


# ---- near ------------------------------------------------------------------------------

def brute_near(pairs, percent):
    sets = [{tuple(w[i: i + 5]) for i in range(max(1, len(w) - 4))} if (w := lowered(t).split()) else set()
            for _, t in pairs]
    parent = list(range(len(pairs)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[top(i)] = top(j)
    least = {}
    for i, (d, _) in enumerate(pairs):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    out = [(d, len(s), least.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(pairs, sets))]
    return sorted(out, key=repr)


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_equal_brute_force(spark, percent):
    pairs = [(r.doc_id, r.text) for r in awkward(spark).collect()]
    for family in range(12):
        base = prose(family, 30 + 25 * family)
        pairs += [(1000 + 100 * family + k, edited(base, 50 * family + k, share))
                  for k, share in enumerate([0, 0, 0.003, 0.006, 0.01, 0.02, 0.03, 0.2])]
    got = near_dedup.near_duplicates(documents(spark, pairs).repartition(4), percent)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute_near(pairs, percent)
    assert got.where("kept <> (doc_id <=> component_id)").count() == 0


def test_chain_is_one_component(spark):
    base = prose(1, 200).split()
    pairs = []
    for k in range(12):
        pairs.append((100 - k, " ".join(base)))
        base[15 * k + 3] = f"new{k}"
    got = near_dedup.near_duplicates(documents(spark, pairs))
    assert {r.component_id for r in got.collect()} == {89}
    assert [r.doc_id for r in near_dedup.keep_one_each(documents(spark, pairs)).collect()] == [89]


def test_blocks_of_a_family_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 300)
    base = prose(3, 120)
    pairs = [(k, edited(base, k, 0.012)) for k in range(60)]
    got = near_dedup.near_duplicates(documents(spark, pairs), 85)
    assert rows(got, "doc_id", "n_shingles", "component_id") == brute_near(pairs, 85)


def test_block_links_counts_exactly():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 60, 40)) for _ in range(30)]
    found = near_dedup.block_links(np.full(30, 2), np.arange(30), sets, 50)
    parent = list(range(30))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in found:
        assert 100 * len(set(sets[i]) & set(sets[j])) >= 50 * len(set(sets[i]) | set(sets[j]))
        parent[top(i)] = top(j)
    for i in range(30):
        for j in range(i):
            a, b = set(sets[i]), set(sets[j])
            if 100 * len(a & b) >= 50 * len(a | b):
                assert top(i) == top(j)


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 130)] + [(7, 7)],
                                  "a long, b long")
    got = {r.node: r.root for r in components(edges, "t").collect()}
    assert all(got[i] == 1 for i in range(2, 41)) and all(got[k] == 100 for k in range(101, 130))


# ---- substring -------------------------------------------------------------------------

def test_compact_windows_equal_the_definition():
    r = np.random.default_rng(1)
    for _ in range(60):
        n, least = int(r.integers(1, 90)), int(r.integers(1, 12))
        v = r.integers(1, 25, n).astype(np.uint64)
        v[r.random(n) < 0.05] = 0
        expected = set()
        for c in np.flatnonzero(v):
            low = high = int(c)
            while low > 0 and v[low - 1] > v[c]:
                low -= 1
            while high < n - 1 and v[high + 1] >= v[c]:
                high += 1
            if high - low + 1 >= least:
                expected.add((low, int(c), high))
        assert set(zip(*(x.tolist() for x in substring_dedup.compact_windows(v, least)))) == expected


def longest_common(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else 0)
        best, row = max(best, max(new)), new
    return best


def test_repeated_passages(spark):
    shared, long_shared = prose(900, 70, 10 ** 6), prose(901, 300, 10 ** 6)
    pairs = [(1, f"{prose(1, 80, 10 ** 6)} {shared} {prose(2, 40, 10 ** 6)}"),
             (2, f"{prose(3, 200, 10 ** 6)} {shared.upper()}"), (3, prose(4, 500, 10 ** 6)),
             (4, f"{long_shared} {prose(5, 100, 10 ** 6)}"), (5, f"{prose(6, 30, 10 ** 6)} {edited(long_shared, 1, 0.01)}"),
             (6, prose(7, 45, 10 ** 6)), (7, prose(7, 45, 10 ** 6)), (8, prose(8, 60, 10 ** 6)), (9, prose(8, 60, 10 ** 6)),
             (10, " ".join(prose(900, 70, 10 ** 6).split()[:40])), (11, None), (12, ""), (None, shared)]
    got = {r.doc_id: r for r in substring_dedup.repeated_passages(documents(spark, pairs)).collect()}
    assert sorted(got) == [2, 5, 9]
    assert tuple(got[2])[:6] == (2, 200, 270, 1, 80, 150) and got[2].similarity == 1.0
    assert got[5].keep_id == 4 and got[5].past_word - got[5].first_word >= 250 and got[5].similarity >= 0.8
    assert tuple(got[9])[:6] == (9, 0, 60, 8, 0, 60)


def test_passages_that_many_documents_share(spark):
    shared = prose(77, 90, 10 ** 6)
    pairs = [(i, f"{prose(i, 20 + i, 10 ** 6)} {shared} {prose(500 + i, 30, 10 ** 6)}") for i in range(40)]
    got = substring_dedup.repeated_passages(documents(spark, pairs)).collect()
    assert sorted(r.doc_id for r in got) == list(range(1, 40)) and {r.keep_id for r in got} == {0}
    for r in got:
        assert (r.first_word, r.past_word) == (20 + r.doc_id, 110 + r.doc_id)


def test_passage_behind_documents_that_only_hold_its_least_words(spark):
    words, least = prose(4242, 60, 10 ** 6).split(), 46

    def places(text):
        hashes = shingle_hashes(text.encode(), 5)
        return [set(substring_dedup.compact_windows(np.maximum(substring_dedup.mix(hashes ^ seed) >> np.uint64(32), np.uint64(1)),
                                                    least)[1].tolist()) for seed in substring_dedup._SEEDS]

    decoys, seed = [], 0
    for f, found in enumerate(places(" ".join(words))):
        for c in found:
            while True:
                seed += 1
                text = f"{prose(10_000 + seed, 30, 10 ** 6)} {' '.join(words[c: c + 5])} {prose(90_000 + seed, 30, 10 ** 6)}"
                held = places(text)
                if 30 in held[f] and not any(30 in h for i, h in enumerate(held) if i != f):
                    decoys.append(text)
                    break
    pairs = [*enumerate(decoys), (1000, " ".join(words)), (1001, " ".join(words))]
    got = substring_dedup.repeated_passages(documents(spark, pairs)).collect()
    assert [tuple(r)[:6] for r in got] == [(1001, 0, 60, 1000, 0, 60)]


def test_functions_agree_by_place_and_miss_rarely(spark):
    columns = "doc long, other long, f long, d long, low long, high long"
    met = [(1, 0, 0, 0, 10, 60), (1, 0, 3, 30, 50, 110),  # functions 0 and 3 lie over places 50 to 60, 30 diagonals apart
           (2, 0, 0, 0, 10, 60), (2, 0, 3, 0, 61, 110),  # side by side
           (3, 0, 2, 0, 10, 60), (3, 0, 2, 0, 20, 70)]  # one function only
    got = substring_dedup._candidates(spark.createDataFrame(met, columns)).collect()
    assert [(r.doc, r.other, sorted(r.diagonals)) for r in got] == [(1, 0, [0, 30])]
    n = substring_dedup.FUNCTIONS
    assert substring_dedup.ENOUGH == 2 and 0.2 ** n + n * 0.8 * 0.2 ** (n - 1) < 0.002


def test_documents_that_share_a_line_only_do_not_meet(spark, monkeypatch):
    met, stretches = [], substring_dedup._stretches
    monkeypatch.setattr(substring_dedup, "_stretches", lambda m, least: met.append(m.count()) or stretches(m, least))
    line, passage = prose(1, 14), prose(2, 60)
    pairs = [(i, f"{prose(10 + i, 60, 10 ** 6)} {line} {prose(50 + i, 60, 10 ** 6)}") for i in range(30)]
    assert substring_dedup.repeated_passages(documents(spark, pairs)).count() == 0 and sum(met) == 0
    pairs += [(i, f"{prose(100 + i, 60, 10 ** 6)} {passage}") for i in (40, 41)]
    assert rows(substring_dedup.repeated_passages(documents(spark, pairs)), "doc_id", "keep_id") == [(41, 40)] and sum(met) > 0


@pytest.mark.parametrize("seed", range(4))
def test_dense_places_equal_brute_force(seed):
    flags = np.random.default_rng(seed).random(60) < 0.5 + 0.1 * seed
    expected = np.zeros(60, bool)
    for x in range(60):
        for y in range(x + 7, 61):
            if 100 * flags[x:y].sum() >= 70 * (y - x):
                expected[x:y] = True
    assert (substring_dedup.dense(flags, 7, 70) == expected).all()


def packed_windows(rng, n, period):
    """Windows of one value in a text that repeats itself, some with other gaps and reaches."""
    s, gaps = substring_dedup, np.where(rng.random(n) < 0.8, period, rng.integers(1, 90, n))
    c = 200 + np.cumsum(gaps)
    left = np.minimum(gaps - 1, rng.integers(30, 200, n))
    right = np.where(rng.random(n) < 0.9, c[-1] + 50 - c, rng.integers(20, 60, n))
    return np.sort((c << s.REACH_BITS | left) << (s.REACH_BITS + s.FUNCTION_BITS) | right << s.FUNCTION_BITS | 3)


@pytest.mark.parametrize("seed", range(6))
def test_left_out_meetings_lie_inside_others(seed):
    r, s = np.random.default_rng(seed), substring_dedup
    n, k = r.integers(1, 12, 5), r.integers(1, 12, 5)
    a, b = (np.concatenate([packed_windows(r, x, 40) for x in sizes]) for sizes in (n, k))
    order, begin, times = s._meetings(a, n, b, k)
    row, start = np.repeat(np.arange(5), n), np.cumsum(k) - k
    some = [(i, order[start[row[i]] + (begin[i] + t) % k[row[i]]]) for i in range(len(a)) for t in range(times[i])]
    every = [(i, start[row[i]] + t) for i in range(len(a)) for t in range(k[row[i]])]
    assert len(set(some)) == len(some) and set(some) <= set(every)
    found = [s._merged(a[x], b[y], row[x] + 10, row[x], 46) for x, y in (np.array(m).T for m in (some, every))]
    assert all((x == y).all() for x, y in zip(*found))


def test_a_line_held_many_times_meets_once_per_diagonal():
    s, n, k = substring_dedup, np.array([3000]), np.array([2000])
    a, b = ((c << s.REACH_BITS | 39) << (s.REACH_BITS + s.FUNCTION_BITS) | c[-1] + 50 - c << s.FUNCTION_BITS
            for c in (200 + 40 * np.arange(x[0]) for x in (n, k)))
    assert s._meetings(a, n, b, k)[2].sum() == 3000 + 2000 - 1


@pytest.mark.parametrize("seed", range(4))
def test_runs_and_outermost_passages_equal_brute_force(seed, monkeypatch):
    r, s = np.random.default_rng(seed), substring_dedup
    monkeypatch.setattr(s, "PLACES", 100)
    a, b = (r.integers(-1, 2, x).astype(np.int32) for x in (60, 45))
    expected = []
    for d in range(-50, 70):
        same = [0 <= x - d < 45 and a[x] == b[x - d] for x in range(60)] + [False]
        x = 0
        for y in range(61):
            if not same[y]:
                if y - x >= s.RUN:
                    expected.append((x, y, d))
                x = y + 1
    assert s._runs(a, b, np.arange(-50, 70)) == sorted(expected, key=lambda run: (run[0], -run[1], run[2]))
    spans = [(int(k), int(x), int(x + w)) for k, x, w in zip(r.integers(0, 4, 80), r.integers(0, 40, 80), r.integers(1, 20, 80))]
    inside = [any(x <= first and y >= past and (k < keep or k == keep and y - x > past - first) for k, x, y in spans)
              for keep, first, past in spans]
    assert [not x for x in inside] == s._outermost(spans)


def test_only_the_least_of_equal_texts_meets_others(spark, monkeypatch):
    met, stretches = [], substring_dedup._stretches
    monkeypatch.setattr(substring_dedup, "_stretches", lambda m, least: met.append(
        {x for r in m.select("doc", "other").collect() for x in r}) or stretches(m, least))
    shared, text = prose(71, 90, 10 ** 6), prose(72, 70, 10 ** 6)
    rest = f"{shared} {prose(73, 60, 10 ** 6)}"
    pairs = [(1, f"{prose(74, 40, 10 ** 6)} {shared}"), *((i, rest) for i in range(10, 40)), *((i, text) for i in range(50, 80)),
             (90, prose(75, 30)), (91, prose(75, 30))]
    got = rows(substring_dedup.repeated_passages(documents(spark, pairs)), "doc_id", "first_word", "past_word", "keep_id", "keep_first")
    expected = [(10, 0, 90, 1, 40), *((i, *x) for i in range(11, 40) for x in ((0, 90, 1, 40), (0, 150, 10, 0))),
                *((i, 0, 70, 50, 0) for i in range(51, 80))]
    assert got == sorted(expected, key=repr) and set().union(*met) == {1, 10}


@pytest.mark.parametrize("seed", range(3))
def test_runs_of_many_pairs_equal_those_of_each(seed, monkeypatch):
    r, s = np.random.default_rng(seed), substring_dedup
    monkeypatch.setattr(s, "PLACES", 300)
    pairs = []
    for _ in range(200):
        n, m, k = int(r.integers(0, 90)), int(r.integers(0, 90)), int(r.integers(0, 60))
        a, b = r.integers(0, 400, n), r.integers(0, 400, m)
        x, y = (int(r.integers(0, max(1, z - k))) for z in (n, m))
        k = min(k, n - x, m - y)
        b[y: y + k] = a[x: x + k]
        b[r.random(m) < 0.03] = 7
        pairs.append((a.astype(np.int32), b.astype(np.int32), np.unique([x - y, *r.integers(-90, 90, r.integers(0, 14))])))
    lists = [pa.array([p[i] for p in pairs], pa.list_(pa.int32())) for i in range(3)]
    got = {int(i): found for i, runs in s._many_runs(lists, 10, 80) if (found := s._chained(runs, 14, 80))}
    assert got == {i: found for i, p in enumerate(pairs) if (found := s.aligned(*p, 14, 80))} and len(got) > 20


def test_an_id_that_repeats_counts_once(spark):
    shared = prose(31, 80, 10 ** 6)
    pairs = [(2, f"{prose(32, 60, 10 ** 6)} {shared}"), (5, shared), (5, shared), (5, prose(33, 90, 10 ** 6)), (2, None)]
    docs = documents(spark, pairs)
    got = substring_dedup._windows(docs.selectExpr("doc_id as id", "cast(coalesce(text, '') as binary) as text"), 46, 80)
    assert got.groupBy("doc", "key").count().where("count > 1").count() == 0


def test_every_long_common_run_is_reported(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r.doc_id, lowered(r.text).split()) for r in docs.collect()]
    first, wanted = {}, set()
    for i, w in sorted(pairs):
        for k in range(len(w) - 49):
            if first.setdefault(tuple(w[k: k + 50]), i) != i:
                wanted.add(i)
    got = substring_dedup.repeated_passages(docs).collect()
    assert wanted <= {r.doc_id for r in got}
    words = dict(pairs)
    for r in got:  # and what is reported is similar
        a, b = words[r.doc_id][r.first_word: r.past_word], words[r.keep_id][r.keep_first: r.keep_past]
        assert min(len(a), len(b)) >= 50
        x, y = (set(shingle_hashes(b" ".join(v), 5).tolist()) for v in (a, b))
        assert len(x & y) >= 0.75 * len(x | y)


def near_copies(n):
    text = prose(81, 300, 10 ** 6)
    return [(i, f"{prose(600 + i, 20, 10 ** 6)} {edited(text, i, 0.06)}") for i in range(n)]


def test_a_turn_in_parts_finds_the_same(spark, monkeypatch):
    docs = documents(spark, near_copies(40))
    columns = ["doc_id", "first_word", "past_word", "keep_id", "keep_first", "keep_past"]
    whole, parts = rows(substring_dedup.repeated_passages(docs), *columns), []
    monkeypatch.setattr(substring_dedup, "_number_of_parts", lambda total, limit: parts.append((total, limit)) or 3)
    assert rows(substring_dedup.repeated_passages(docs), *columns) == whole and len({r[0] for r in whole}) > 30
    assert len(parts) > 8 and any(total > 0 for total, _ in parts) and all(limit > 0 for _, limit in parts)
    monkeypatch.undo()
    assert [substring_dedup._number_of_parts(x, 10) for x in (0, 10, 11, 95)] == [1, 1, 2, 10]


def test_nothing_stored_on_the_way_stays(spark, monkeypatch):
    import glob
    import re
    import time

    def folders():
        return set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/marketlake-*"))

    def shuffled():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {x for x in (files.apply(i).getName() for i in range(files.size())) if x.startswith("shuffle")}

    before, files, late, outer = folders(), shuffled(), [], substring_dedup._outer
    monkeypatch.setattr(substring_dedup, "_outer", lambda found: late.append(folders() - before) or outer(found))
    got = substring_dedup.repeated_passages(documents(spark, near_copies(12)))
    purposes = lambda paths: {re.fullmatch(r".*/marketlake-(\w+)-\w+", x)[1] for x in paths}
    assert purposes(folders() - before) == {"copies", "kept"} and not {"windows", "digests", "pairs"} & purposes(*late)
    for _ in range(100):
        if not (left := shuffled() - files):
            break
        time.sleep(0.1)
    assert not left and got.count() >= 11


def test_awkward_rows(spark):
    got = rows(substring_dedup.repeated_passages(awkward(spark)), "doc_id", "first_word", "past_word", "keep_id")
    assert got == [(7, 0, 30_000, 6)]


def test_many_small_sets_meet_in_bounded_memory():
    """Short templated texts: all share most of their shingles, none is linked."""
    import tracemalloc
    n = near_dedup.BLOCK_SETS
    common = np.arange(7, dtype=np.int64)
    sets = [np.append(common, 100 + i) for i in range(2 * n)]  # 7 of 9 shared: 0.78
    sides = np.repeat([0, 1], n)
    tracemalloc.start()
    assert near_dedup.block_links(sides, np.arange(2 * n), sets, 80) == []
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    sets[3], sets[n + 5] = sets[0], sets[7]
    assert near_dedup.block_links(sides, np.arange(2 * n), sets, 80) == [(7, n + 5)]


def test_blocks_are_bounded_by_sets_too(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_SETS", 8)
    pairs = [(i, f"page {i} of this site was not found please try again later or go home now") for i in range(60)]
    pairs += [(100 + i, prose(500 + i // 3, 200) + f" end {i}") for i in range(30)]
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(documents(spark, pairs), 85).collect()}
    assert all(got[i] == i for i in range(60)) and all(got[100 + i] == 100 + i - i % 3 for i in range(30))
