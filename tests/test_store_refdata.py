import json
from datetime import datetime, timezone

import pytest

from marketlake.operators import books as K
from marketlake.operators import coverage as C
from marketlake.operators import health as H
from marketlake.operators import refdata as D
from marketlake.plans import pipeline as P
from marketlake.plans.status import status_report
from marketlake.schemas import META_SCHEMAS, schema_for
from marketlake.sources import venues as V
from tests.helpers import S, T, bars, rows, trades


def test_schema_lookup():
    assert schema_for("trades").fieldNames()[0] == "ts_ns"
    with pytest.raises(KeyError):
        schema_for("nope")


def test_missing_tables_are_empty(lake):
    assert lake.table("quotes").count() == 0 and "bid_px" in lake.table("quotes").columns
    assert lake.meta("coverage").count() == 0
    assert lake.sql("SELECT count(*) AS n FROM trades").first()["n"] == 0


def test_append_keeps_duplicates_and_splits_by_utc_date(spark, lake):
    midnight = T - T % (86400 * S) + 86400 * S
    t = trades(spark, [(midnight - 1, "okx", 1, 1), (midnight, "okx", 2, 1)])
    lake.append("trades", t)
    lake.append("trades", t)
    got = lake.table("trades")
    assert got.count() == 4
    assert {r["date"] for r in got.select("date").distinct().collect()} == {"2023-11-14", "2023-11-15"}


def test_compaction_keeps_rows_and_order(spark, lake):
    for part in range(4):
        lake.append("trades", trades(spark, [(T + part, "okx", part, 1), (T + 9, "okx", 50 + part, 1)]))
    before = [(r["price"]) for r in _stored(lake)]
    assert lake.compact("trades") == 4
    assert lake.files("trades").count() == 1
    assert [(r["price"]) for r in _stored(lake)] == before == [0, 1, 2, 3, 50, 51, 52, 53]
    assert lake.compact("trades") == 0  # one file: left alone


def test_compaction_merges_small_files_only(spark, lake):
    for part in range(6):
        lake.append("trades", trades(spark, [(T + part, "okx", part, 1), (T + part, "kraken", part, 1)]))
    size = lake.files("trades").first()["bytes"]
    assert lake.compact("trades", target_bytes=size) == 0  # all at least half of the target
    assert lake.compact("trades", target_bytes=4 * size) >= 10
    left = lake.files("trades").count()
    assert left <= 6 and lake.table("trades").count() == 12
    assert lake.compact("trades", target_bytes=size) == 0 and lake.files("trades").count() == left


def test_compaction_by_limited_runs(spark, lake):
    for part in range(5):
        lake.append("trades", trades(spark, [(T + part, v, part, 1) for v in ("okx", "kraken")]))
    assert lake.compact("trades", most_files=7) == 5 and lake.compact("trades", most_files=7) == 5
    assert lake.files("trades").count() == 2 and lake.table("trades").count() == 10


def test_rows_appended_during_compaction_survive(spark, lake, monkeypatch):
    for part in range(3):
        lake.append("trades", trades(spark, [(T + part, "okx", part, 1)]))
    publish = lake._publish

    def late(*args):
        lake.append("trades", trades(spark, [(T + 50, "okx", 50, 1)]))
        publish(*args)

    monkeypatch.setattr(lake, "_publish", late)
    assert lake.compact("trades") == 3
    assert [r["price"] for r in _stored(lake)] == [0, 1, 2, 50]


def test_compaction_goes_on_after_a_crash(spark, lake, monkeypatch):
    from marketlake.sources.store import Files
    for part in range(3):
        lake.append("trades", trades(spark, [(T + part, "okx", part, 1)]))
    with monkeypatch.context() as m:
        def fail(self, name):
            raise RuntimeError("lost")
        m.setattr(Files, "delete", fail)
        with pytest.raises(RuntimeError):
            lake.compact("trades")
    lake.compact("trades")
    assert [r["price"] for r in _stored(lake)] == [0, 1, 2]


def test_append_once(spark, lake, monkeypatch):
    from marketlake.sources.store import Files
    one = trades(spark, [(T, "okx", 1, 1)])
    assert lake.append_once("trades", one, "job-1") and not lake.append_once("trades", one, "job-1")
    with monkeypatch.context() as m:
        move = Files.move

        def fail(self, source, target):
            move(self, source, target)
            raise RuntimeError("lost")
        m.setattr(Files, "move", fail)
        with pytest.raises(RuntimeError):
            lake.append_once("trades", trades(spark, [(T + 1, "okx", 2, 1)]), "job-2")
    assert not lake.append_once("trades", trades(spark, [(T + 1, "okx", 2, 1)]), "job-2")
    lake.append("trades", trades(spark, [(T + 2, "okx", 3, 1)]))
    assert [r["price"] for r in _stored(lake)] == [1, 2, 3]


def test_order_of_arrival_survives_the_store(spark, lake):
    from marketlake.operators.bars import bars_from_trades
    from marketlake.sources.store import ARRIVAL
    first = trades(spark, [(T, "okx", 100, 1), (T, "okx", 101, 1)])
    first = first.withColumn("recv_ns", first["ts_ns"] + 1000 - first["price"].cast("long"))
    lake.append("trades", first.coalesce(1))
    got = bars_from_trades(lake.arrivals("trades"), ARRIVAL).collect()[0]
    assert (got["open"], got["close"]) == (100, 101)


def _bar(lake):
    from marketlake.operators.bars import bars_from_trades
    from marketlake.sources.store import ARRIVAL
    return bars_from_trades(lake.arrivals("trades"), ARRIVAL).collect()[0]


@pytest.mark.parametrize("form", ["parquet", "json"])
def test_file_and_row_are_the_order_of_arrival(spark, lake, tmp_path, form):
    """Spark reads the large file first; the small one was landed before it. A shuffle on the way changes nothing."""
    trades(spark, [(T, "okx", 100, 1)]).coalesce(1).write.format(form).save(str(tmp_path / "a"))
    many = trades(spark, [(T, "okx", 101 + i % 2, 1) for i in range(20_000)])
    many.coalesce(1).write.format(form).save(str(tmp_path / "b"))
    landed = spark.read.schema(many.schema).format(form).load([str(tmp_path / "a"), str(tmp_path / "b")])
    lake.append("trades", landed)
    assert (_bar(lake)["open"], _bar(lake)["close"]) == (100, 102)
    from marketlake.sources.arrival import file_position
    shuffled = file_position(landed).repartition(7)
    other = type(lake)(spark, f"{lake.base}-shuffled")
    other.append("trades", shuffled)
    assert (_bar(other)["open"], _bar(other)["close"]) == (100, 102)
    assert file_position(landed.groupBy("venue").count()) is None


def test_rows_of_a_message_keep_their_place(spark, lake):
    """Two events of several trades in one message, and messages of one moment on two connections."""
    import json as J

    from marketlake.sources.frames import normalise

    def text(*events):
        return J.dumps({"channel": "market_trades", "events": [{"type": "update", "trades": [
            {"product_id": "BTC-USD", "time": "2026-05-12T10:00:00Z", "price": str(p), "size": "1", "side": "BUY", "trade_id": str(p)}
            for p in prices]} for prices in events]})

    raw = [("c2", 1, 20, text([7], [9])), ("c1", 8, 20, text([6])), ("c1", 3, 10, text([5, 4], [3, 2])), ("c1", 9, 20, text([8]))]
    frames = spark.createDataFrame([(c, s, r, "coinbase", x) for c, s, r, x in raw],
                                   "conn_id string, seq long, recv_ns long, venue string, raw string").repartition(3)
    lake.append("trades", normalise(frames, "coinbase", "trades").repartition(5))
    assert [r["price"] for r in _stored(lake)] == [5, 4, 3, 2, 6, 8, 7, 9]
    assert (_bar(lake)["open"], _bar(lake)["close"]) == (5, 9)


def test_streamed_files_keep_file_and_row(spark, lake, tmp_path):
    from marketlake.streaming.jobs import write_raw
    trades(spark, [(T, "okx", 100, 1)]).coalesce(1).write.parquet(str(tmp_path / "in" / "a"))
    trades(spark, [(T, "okx", 101 + i % 2, 1) for i in range(20_000)]).coalesce(1).write.parquet(str(tmp_path / "in" / "b"))
    stream = spark.readStream.schema(trades(spark, []).schema).parquet(str(tmp_path / "in" / "*"))
    write_raw(stream, "trades", lake, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert (_bar(lake)["open"], _bar(lake)["close"], _bar(lake)["trades"]) == (100, 102, 20_001)


def test_two_runs_may_finish_one_batch(spark, lake, monkeypatch):
    from marketlake.sources.store import Files
    for i in range(4):
        lake.append("trades", trades(spark, [(T + i, "okx", i, 1)]))
    move, inside = Files.move, []

    def also_elsewhere(self, source, target):
        if not inside:
            inside.append(1)
            for planned in self.children(f"{lake.path('trades')}/_log"):
                lake._carry_out(self, "trades", planned.rpartition("/")[2].removesuffix(".planned"))
        move(self, source, target)

    monkeypatch.setattr(Files, "move", also_elsewhere)
    assert lake.compact("trades") == 4
    assert [r["price"] for r in _stored(lake)] == [0, 1, 2, 3] and inside


def test_compaction_leaves_a_stream_batch_to_its_stream(spark, lake, monkeypatch):
    from marketlake.sources.store import Files
    with monkeypatch.context() as m:
        m.setattr(Files, "move", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            lake.append_once("trades", trades(spark, [(T, "okx", 1, 1)]), "stream-trades-0")
    assert lake.compact("trades") == 0 and lake.table("trades").count() == 0
    assert not lake.append_once("trades", trades(spark, [(T, "okx", 1, 1)]), "stream-trades-0")
    assert lake.table("trades").count() == 1


def test_stored_files_are_zstd_with_dictionaries(spark, lake, tmp_path):
    import glob

    import pyarrow.parquet as pq
    from marketlake.sources.store import encoding
    lake.append("trades", trades(spark, [(T + i, "okx", i % 3, 1) for i in range(5000)]))
    files = glob.glob(f"{lake.path('trades')}/symbol=*/venue=*/date=*/*.parquet")
    column = pq.ParquetFile(files[0]).metadata.row_group(0).column(pq.ParquetFile(files[0]).schema_arrow.names.index("price"))
    assert column.compression == "ZSTD" and any("DICTIONARY" in e for e in column.encodings)
    assert encoding()["parquet.compression.codec.zstd.level"] == "6"


def test_json_of_other_dates_stays(spark, lake, tmp_path):
    day = 86400 * S

    lake.append("bars_1s", bars(spark, [dict(ts_ns=T - T % S + i * S + d * day) for d in range(2) for i in range(5)]))
    P.write_daily_quality(lake, json_dir=str(tmp_path / "j"))
    P.write_daily_quality(lake, dates=["2023-11-14"], json_dir=str(tmp_path / "j"))
    assert sorted(p.name for p in (tmp_path / "j").glob("date=*")) == ["date=2023-11-14", "date=2023-11-15"]


def test_pivots_refuse_unlisted_venues(spark):
    from marketlake.operators.analytics import wide_closes
    from marketlake.plans.query import funding_wide

    b = bars(spark, [dict(venue="okx"), dict(venue="kraken")])
    assert {"okx", "kraken"} <= set(wide_closes(b).columns)
    with pytest.raises(Exception, match="kraken"):
        wide_closes(b, ["okx"]).collect()
    rates = spark.createDataFrame([(T, T, "A", "okx", 0.1, 5), (T, T, "B", "okx", 0.9, 5)],
                                  "ts_ns long, recv_ns long, symbol string, venue string, funding_rate double, ingested_at_ns long")
    assert sorted(r["okx"] for r in funding_wide(rates, ["okx"]).collect()) == [0.1, 0.9]


def _stored(lake):
    from marketlake.sources.store import ARRIVAL
    return lake.arrivals("trades").orderBy("ts_ns", *ARRIVAL).collect()


def test_symbols(spark):
    own = {(v, n.upper()): c for c, v, n in V.LISTED}
    for (venue, native), canonical in own.items():
        assert V.listing().tickers(venue)[native] == canonical
    assert V.listing().tickers("bybit")["BTCUSDT"] == "BTC-USDT-PERP"  # the later listing wins
    assert "NOPE" not in V.listing().tickers("binance") and V.listing().tickers("nowhere") == {}
    bits = V.mask_bits()
    assert len(set(bits.values())) == 9 and all(b & (b - 1) == 0 for b in bits.values())
    assert ("BTC-USD", "kraken", "XBTUSD") in V.LISTED and ("ETH-USDT", "bitfinex", "tETHUST") in V.LISTED
    assert [r.canonical for r in V.list_symbols(spark, "coinbase").collect()] == ["BTC-USD", "ETH-USD", "SOL-USD", "XRP-USD"]
    perps = V.listing().frame(spark).where("asset_class = 'perp'").select("canonical").distinct()
    assert perps.count() == 5


def test_given_listing(spark):
    from marketlake.sources.frames import normalise
    given = spark.createDataFrame([("NEW-USD", "coinbase", "odd.ticker")], "canonical string, venue string, native string")
    raw = ('{"channel":"market_trades","events":[{"trades":[{"product_id":"ODD.ticker","price":"1.5","size":"2",'
           '"side":"BUY","time":"2026-05-12T00:00:00Z","trade_id":"7"}]}]}')
    frames = spark.createDataFrame([("c", 1, 5, "coinbase", raw)], "conn_id string, seq long, recv_ns long, venue string, "
                                                                   "raw string")
    assert normalise(frames, "coinbase", "trades").where("symbol is not null").count() == 0
    V.use_listing(given)
    try:
        assert [r.symbol for r in normalise(frames, "coinbase", "trades").collect()] == ["NEW-USD"]
        assert [tuple(r) for r in V.symbol_dim(spark).collect()] == [("NEW-USD", "coinbase", "odd.ticker", 0)]
        assert [r.canonical for r in V.list_symbols(spark).collect()] == ["NEW-USD"]
    finally:
        V.use_listing()


def test_seed_retire_and_asof(spark):
    empty = spark.createDataFrame([], schema_for("symbol_map"))
    once = D.seed_symbol_map(empty, D.listed_mappings(spark))
    twice = D.seed_symbol_map(once, D.listed_mappings(spark))
    assert once.count() == twice.count() > 20
    closed, entry = D.retire_mapping(once, "BTC-USDT", "binance", 500, "gone")
    pair = "canonical = 'BTC-USDT' AND venue = 'binance'"
    assert D.symbol_map_asof(closed, 501).where(pair).count() == 0
    assert D.symbol_map_asof(closed, 499).where(pair).first()["asset_class"] == "spot"
    assert rows(entry)[0]["kind"] == "restatement"
    assert D.list_corrections(entry, table_name="symbol_map", symbol="BTC-USDT").count() == 1


def test_corrections_validated(spark):
    ok = dict(table_name="trades", kind="gap", effective_from_ns=0, effective_to_ns=1)
    assert rows(D.correction(spark, **ok))[0]["severity"] == "info"
    for bad in (dict(kind="oops"), dict(severity="awful")):
        with pytest.raises(ValueError):
            D.correction(spark, **{**ok, **bad})


def test_books(spark):
    def book(i, bids, asks):
        return (T + i, T + i, "BTC-USD", "okx", 3, [{"px": float(p), "sz": 1.0} for p in bids],
                [{"px": float(p), "sz": 3.0} for p in asks], 0)

    df = spark.createDataFrame([book(0, [100, 99], [101, 102]), book(1, [100, 99], [101, 102]),
                                book(2, [102, 99], [101, 102]), book(3, [100, 99], [101, 102]), book(4, [], [101])],
                               schema_for("book_l2_snapshot"))
    top = rows(K.book_top(df), "ts_ns")
    assert len(top) == 4 and top[0]["mid"] == 100.5 and top[0]["imbalance"] == -0.5
    q = rows(K.book_quality(df))[0]
    assert (q["crossed_top"], q["empty_side"], q["clean_pct"]) == (1, 1, 60.0)
    assert {r["issue"] for r in rows(K.book_issues(df))} == {"crossed_top", "empty_side"}


def test_health(spark):
    seen = [("okx", "a", "trades", T - 1000 * S + i * S) for i in range(1000)]
    seen += [("okx", "b", "trades", T - 3000 * S + i * S) for i in range(1000)]
    df = spark.createDataFrame(seen, "venue string, symbol string, stream string, recv_ns long")
    up = {r["symbol"]: r["up"] for r in rows(H.feed_health(df, T))}
    assert up == {"a": True, "b": False}
    old = df.withColumn("recv_ns", df["recv_ns"] - 9000 * S)
    assert {r["up"] for r in rows(H.feed_health(old, T))} == {True}  # silent past the baseline reads up
    assert {r["up"] for r in rows(H.feed_health(old, T, silent_is_down=True))} == {False}


def test_gap_worklist(spark):
    t = trades(spark, [(T - 30 * S, "okx", 1, 1), (T - 90 * S, "kraken", 1, 1)])
    listed = spark.createDataFrame([(v, "BTC-USDT") for v in ("okx", "kraken", "gemini")], "venue string, symbol string")
    got = {r["venue"]: r["fetch_from_ns"] for r in rows(H.gap_worklist(t, listed, T))}
    assert got == {"kraken": T - 90 * S + 1, "gemini": T - 7200 * S + 1}


def test_pipeline(spark, lake):
    ticks = [(T + i * S // 3, v, 100 + (i % 4) / 100, 1, None, i)
             for i in range(600) for v in ("binance", "coinbase", "kraken")]
    lake.append("trades", trades(spark, ticks))
    manifest = json.loads(P.build_dataset(lake, {"run": 1}))
    assert manifest["bars_built"] == {"per_venue_1s": 600, "agg_1s": 200, "slices": 1}
    assert manifest["quality"]["slices"] == 4 and manifest["quality"]["min_score"] > 0
    bars = lake.table("bars_1s")
    from marketlake.plans.query import get_bars
    minute = rows(get_bars(bars, "BTC-USDT", T, T + 200 * S, "1m"))
    assert all(99 <= r["close"] <= 101 for r in minute) and len(minute) >= 3
    report = {k: v.count() for k, v in status_report(lake).items()}
    assert report["coverage"] == 2 and report["quality"] == 4 and report["corrections"] == 1
    cov = {r["table_name"]: r for r in rows(C.by_table(lake.meta("coverage")))}
    assert cov["trades"]["rows"] == 1800 and cov["trades"]["bytes"] > 0
    lines = rows(C.matrix_markdown(lake.meta("coverage")))
    assert lines[0]["line"].startswith("| symbol |") and len(lines) == 4
    assert datetime.fromtimestamp(manifest["built_at_ns"] / S, timezone.utc).year > 2000


def test_spans_come_from_footers(spark, lake):
    from marketlake.session import settings
    from marketlake.sources.store import footer_spans
    for part in range(3):
        lake.append("trades", trades(spark, [(T + i * S, v, 1, 1) for i in range(part, 900, 3) for v in ("okx", "kraken")]))
    lake.append("trades", trades(spark, [(T + 86400 * S, "okx", 1, 1)]))
    got = rows(lake.spans("trades"), "date", "venue")
    assert [(r["venue"], r["date"], r["rows"], r["first_ts_ns"], r["last_ts_ns"]) for r in got] == [
        ("kraken", "2023-11-14", 900, T, T + 899 * S), ("okx", "2023-11-14", 900, T, T + 899 * S),
        ("okx", "2023-11-15", 1, T + 86400 * S, T + 86400 * S)]
    with settings(spark, spark__sql__sources__useV1SourceList="", spark__sql__parquet__aggregatePushdown="true"):
        schema = "ts_ns long, symbol string, venue string, date string"
        plan = footer_spans(lake.read_or_none(lake.path("trades"), schema))._jdf.queryExecution().toString()
    assert "PushedAggregation: [COUNT(*), MIN(ts_ns), MAX(ts_ns)]" in plan
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"
    assert C.stored_coverage(lake).where("bytes_on_disk = 0").count() == 0


def test_report_falls_back_on_artefacts(spark, lake, tmp_path):
    from marketlake.plans.status import write_artefacts
    lake.append("bars_1s", bars(spark, [dict(ts_ns=T - T % S + i * S) for i in range(5)]))
    P.write_coverage(lake)
    write_artefacts(lake, str(tmp_path / "json"))
    bare = type(lake)(spark, str(tmp_path / "bare"))
    assert status_report(bare)["coverage"].count() == 0
    assert status_report(bare, str(tmp_path / "nowhere"))["coverage"].count() == 0
    found = rows(status_report(bare, str(tmp_path / "json"))["coverage"])
    assert [(r["table_name"], r["rows"]) for r in found] == [("bars_1s", 5)]


@pytest.mark.parametrize("bin_ns", [7, 100, 10_000])
def test_mappings_at_many_instants_equal_brute_force(spark, bin_ns):
    import random

    from marketlake.operators.refdata import symbol_map_asof_many
    rng = random.Random(2)
    maps = []
    for i in range(60):
        start = rng.randrange(-200, 1200)
        maps.append((f"C{i % 7}", rng.choice(["okx", "kraken"]), f"N{i}", "spot", "b", "q", start,
                     rng.choice([None, start, start + rng.randrange(400)]), None))
    instants = [(rng.choice(["okx", "kraken"]), 500 if i < 40 else rng.randrange(1000), i) for i in range(120)]
    mapping = spark.createDataFrame(maps, META_SCHEMAS["symbol_map"])
    asked = spark.createDataFrame([(v, t, i) for v, t, i in instants], "venue string, ts_ns long, i long")
    for keys in ((), ("venue",)):
        table = asked if keys else asked.drop("venue")
        got = sorted((r["i"], r["native"]) for r in symbol_map_asof_many(mapping, table, keys=keys, bin_ns=bin_ns).collect())
        assert got == sorted((i, m[2]) for v, t, i in instants for m in maps
                             if m[6] <= t and (m[7] is None or m[7] > t) and (not keys or m[1] == v))
    assert symbol_map_asof_many(mapping, asked.drop("venue").limit(0)).count() == 0


def test_health_needs_no_stored_counts(spark, lake, tmp_path):
    """Rates over several batches from bounded state; the log's files are merged, its rows stay."""
    import random

    from marketlake.streaming.jobs import counts_stream, write_health
    rng = random.Random(8)
    minute = 60 * S
    seen = [(v, "BTC-USDT", "trades", T - T % minute + m * minute + rng.randrange(minute)) for v in ("okx", "kraken")
            for m in range(150) if not (v == "okx" and 70 <= m < 140) for _ in range(1 if v == "kraken" and m > 60 else rng.randrange(8, 30))]
    seen.sort(key=lambda x: x[3])
    schema = "venue string, symbol string, stream string, recv_ns long"
    source = str(tmp_path / "in")
    for at in range(0, len(seen), 1500):
        spark.createDataFrame(seen[at:at + 1500], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        write_health(counts_stream(stream), lake, str(tmp_path / "cp"), available_now=True, merge_every=1000).awaitTermination()
    want = H.health_series(H.per_step_counts(spark.createDataFrame(seen, schema)))
    closed = max(x[3] for x in seen) - 5 * S
    key = ["ts_ns", "venue"]
    expected = [(r["ts_ns"], r["venue"], r["up"], r["recent_per_s"]) for r in rows(want.where(f"ts_ns <= {closed}"), *key)]
    got = lambda: [(r["ts_ns"], r["venue"], r["up"], r["coverage_pct"]) for r in rows(lake.meta("venue_status"), *key)]
    assert got() == expected and not all(e[2] for e in expected)
    import glob
    files = lambda: len(glob.glob(lake.path("venue_status") + "/*.parquet"))
    before = files()
    assert lake.compact_log("venue_status", least=10 ** 6) == 0 and files() == before
    assert lake.compact_log("venue_status", least=2) == before and files() == 1 and got() == expected
