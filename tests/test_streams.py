"""Streams hold a trigger's rows as numbers and let results go in slices; range joins spread over tasks."""

from __future__ import annotations

import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marketlake.schemas import META_SCHEMAS
from marketlake.sources.frames import level2 as L
from marketlake.streaming import jobs as J


class Held:
    """Value or map state in memory."""

    def __init__(self):
        self.value, self.map = None, {}

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def iterator(self):
        return iter(list(self.map.items()))

    def updateValue(self, key, value):
        self.map[key] = value

    def removeKey(self, key):
        del self.map[key]


class Handle:
    def getMapState(self, *_):
        return Held()

    getValueState = getMapState


def parts(rows, columns, size=500):
    return iter(pd.DataFrame(rows[i:i + size], columns=columns) for i in range(0, len(rows), size))


def test_book_stream_lets_snapshots_go_in_slices(monkeypatch):
    monkeypatch.setattr(L, "SLICE_ROWS", 100)
    rng = random.Random(3)
    events = [(i * L.EMIT_EVERY_NS // 2, i, 0, i % 371 == 370,
               [(rng.random() < 0.5, float(rng.randrange(30)), float(rng.randrange(4))) for _ in range(i % 4)]) for i in range(3000)]
    mixed = events[:]
    rng.shuffle(mixed)
    flat = [("S", *e[:4], len(e[4]), *(np.array([u[k] for u in e[4]]) for k in range(3))) for e in mixed]
    columns = ["symbol", *L.ORDER, "clear", "n", "bid", "px", "qty"]
    stream = L.BookStream(3)
    stream.init(Handle())
    out = []
    for trigger in (flat[:2000], flat[2000:]):
        out.append(list(stream.handleInputRows(("S",), parts(trigger, columns), None)))
    assert all(len(f) <= 100 for frames in out for f in frames) and [len(x) for x in out] == [20, 10]
    book: dict = {s: {} for s in L.SIDES}
    last, want = 0, []
    for trigger in (mixed[:2000], mixed[2000:]):
        ordered = [(e[0], e[3], [{"side": L.SIDES[not u[0]], "px": u[1], "qty": u[2]} for u in e[4]]) for e in sorted(trigger, key=lambda e: e[:3])]
        found, last = L.replay(book, last, ordered, 3)
        want += found
    got = pd.concat([f for frames in out for f in frames])
    assert got[["ts_ns", "bids", "asks"]].to_dict("records") == want
    assert {k: v for k, (v,) in stream.levels.map.items()} == {(s, px): q for s in L.SIDES for px, q in book[s].items()}


def test_flat_updates_keep_what_applies(spark):
    rows = [("S", 1, 1, 0, False, [("bid", 1.0, 2.0), (None, 1.0, 1.0), ("ask", None, 1.0), ("ask", 3.0, 0.0), ("x", 1.0, 1.0)]),
            ("S", 2, 1, 0, True, None)]
    got = L.flat_updates(spark.createDataFrame(rows, L.EVENTS)).orderBy("recv_ns").select("n", "bid", "px", "qty").collect()
    assert [tuple(x) for x in got] == [(2, [True, False], [1.0, 3.0], [2.0, 0.0]), (0, [], [], [])]


def test_best_quotes_leave_in_slices(monkeypatch):
    monkeypatch.setattr(J, "SLICE_ROWS", 64)
    rng = random.Random(5)
    rows = [("S", rng.randrange(800), i, *(rng.choice([None, float(rng.randrange(i + 1))]) if k % 2 == 0 else float(i) for k in range(4)))
            for i in range(1000)]
    columns = ["symbol", "recv_ns", "seq", *J.BBO]
    stream = J.BestQuotes()
    stream.init(Handle())
    frames = list(stream.handleInputRows(("S",), parts(rows[:600], columns), None))
    assert max(map(len, frames)) <= 64 and len(frames) == 10
    frames += stream.handleInputRows(("S",), parts(rows[600:], columns), None)
    want, best = [], [None] * 4
    for trigger in (rows[:600], rows[600:]):
        for row in sorted(trigger, key=lambda x: x[1:3]):
            for k in (0, 2):
                if row[3 + k] is not None and (best[k] is None or row[3 + k] >= best[k]):
                    best[k:k + 2] = row[3 + k:5 + k]
            want.append((*row[1:3], *best))
    got = pd.concat(frames)[["recv_ns", "seq", *J.BBO]]
    assert [tuple(None if pd.isna(v) else v for v in x) for x in got.itertuples(index=False)] == want


def test_open_mappings_are_joined_in_many_tasks(spark):
    """Few bytes on either side, many rows out of them: adaptive execution would leave them to one task."""
    from marketlake.operators.refdata import symbol_map_asof_many
    maps = [(f"C{i}", "okx", f"N{i}", "spot", "b", "q", i * 10, None, None) for i in range(300)]
    instants = spark.range(3000).select(F.col("id").alias("ts_ns"))
    got = symbol_map_asof_many(spark.createDataFrame(maps, META_SCHEMAS["symbol_map"]), instants, bin_ns=3)
    per_task = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == sum(t // 10 + 1 for t in range(3000)) and max(per_task) < sum(per_task) / 5


def test_files_of_a_batch_are_moved_together(spark, lake, monkeypatch):
    """Moves overlap, every file arrives, and a fault in one leaves the batch to be finished by the next run."""
    import threading

    import pytest

    from marketlake.sources.store import MOVES_AT_ONCE, Files
    rows = spark.range(400).select((F.col("id") * 3_600_000_000_000).alias("ts_ns"), F.lit("S").alias("symbol"),
                                   F.lit("okx").alias("venue"), F.col("id").cast("double").alias("price"))
    move, lock, together = Files.move, threading.Barrier(4, timeout=20), []

    def met(self, source, target):
        if ".parquet" in source and len(together) < 4:
            together.append(source)
            lock.wait()
            if source == together[0]:
                raise RuntimeError("lost")
        move(self, source, target)

    monkeypatch.setattr(Files, "move", met)
    with pytest.raises(RuntimeError):
        lake.append_once("trades", rows, "job-0")
    monkeypatch.undo()
    assert len(together) == 4 <= MOVES_AT_ONCE and not lake.append_once("trades", rows, "job-0")
    assert sorted(r["price"] for r in lake.table("trades").select("price").collect()) == list(map(float, range(400)))
