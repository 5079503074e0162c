import json
import random

import pytest

from marketlake.schemas import FRAMES
from marketlake.sources.frames import normalise
from marketlake.functions.ordered import ranked, sorted_blocks
from marketlake.sources.frames.level2 import (EVENTS, ORDER, emission_times, event_blocks, kraken_level_events, levels_at_start,
                                              rebuild_books, replay, tree_nodes)
from tests.helpers import S, T, rows

MS = 1_000_000
STAMP = 1_778_600_000_000  # ms


def frames(spark, venue, *messages):
    return spark.createDataFrame(
        [("c1", i, T + i * S, venue, m if isinstance(m, str) else json.dumps(m)) for i, m in enumerate(messages)], FRAMES)


# message, symbol, price, size, side, ts_ns, id
TRADES = {
    "binance": ({"data": {"e": "trade", "s": "BTCUSDT", "t": 7, "p": "61234.5", "q": "0.0123", "T": STAMP, "m": False}},
                ("BTC-USDT", 61234.5, 0.0123, 1, STAMP * MS, "7")),
    "coinbase": ({"channel": "market_trades", "events": [{"trades": [
        {"trade_id": "5", "product_id": "BTC-USD", "price": "61240.55", "size": "0.0042", "side": "SELL",
         "time": "2023-11-14T22:13:20.012345Z"}]}]}, ("BTC-USD", 61240.55, 0.0042, -1, T + 12_345_000, "5")),
    "kraken": ({"channel": "trade", "data": [{"symbol": "BTC/USD", "side": "buy", "price": 61238.1, "qty": 0.0017,
                                              "trade_id": 456, "timestamp": "2023-11-14T22:13:20.5Z"}]},
               ("BTC-USD", 61238.1, 0.0017, 1, T + 500 * MS, "456")),
    "bybit": ({"topic": "publicTrade.BTCUSDT", "data": [{"T": STAMP, "s": "BTCUSDT", "S": "Buy", "v": "0.005",
                                                        "p": "61250.0", "i": "aa"}]},
              ("BTC-USDT-PERP", 61250.0, 0.005, 1, STAMP * MS, "aa")),
    "okx": ({"arg": {"channel": "trades"}, "data": [{"instId": "BTC-USDT", "tradeId": "4", "px": "61245.7",
                                                     "sz": "0.012", "side": "buy", "ts": str(STAMP)}]},
            ("BTC-USDT", 61245.7, 0.012, 1, STAMP * MS, "4")),
    "bitstamp": ({"event": "trade", "channel": "live_trades_btcusdt", "data": {
        "id": 77, "timestamp": "1778600000", "microtimestamp": str(STAMP * 1000 + 5), "amount": 0.0089,
        "price": 61248.0, "type": 0}}, ("BTC-USDT", 61248.0, 0.0089, 1, STAMP * MS + 5000, "77")),
    "gemini": ({"type": "trade", "symbol": "BTCUSDT", "event_id": 33, "timestamp": STAMP, "price": "61252.3",
                "quantity": "0.0033", "side": "sell"}, ("BTC-USDT", 61252.3, 0.0033, -1, STAMP * MS, "33")),
}


@pytest.mark.parametrize("venue", TRADES)
def test_trade_message(spark, venue):
    message, want = TRADES[venue]
    got = rows(normalise(frames(spark, venue, message, "{broken", {"event": "heartbeat"}), venue, "trades"))
    assert len(got) == 1
    r = got[0]
    assert (r["symbol"], r["price"], r["size"], r["side"], r["ts_ns"], r["trade_id"]) == want
    assert r["venue"] == venue and r["recv_ns"] == T


def test_bitfinex_channels(spark):
    f = frames(spark, "bitfinex", [17, "te", [1, STAMP, 1, 9]],  # before its subscription: unknown
               {"event": "subscribed", "channel": "trades", "chanId": 17, "symbol": "tBTCUSD"},
               [17, "te", [2, STAMP, 0.5, 10]], [17, "tu", [2, STAMP, 0.5, 10]], [17, "hb"],
               [17, [[3, STAMP, -1, 11], [4, STAMP, 1, 12]]],
               {"event": "subscribed", "channel": "trades", "chanId": 17, "symbol": "tETHUSD"},
               [17, "te", [5, STAMP, -2, 13]])
    got = [(r["trade_id"], r["symbol"], r["price"], r["size"], r["side"])
           for r in rows(normalise(f, "bitfinex", "trades"), "recv_ns", "trade_id")]
    assert got == [("2", "BTC-USD", 10, 0.5, 1), ("2", "BTC-USD", 10, 0.5, 1), ("3", "BTC-USD", 11, 1, -1),
                   ("4", "BTC-USD", 12, 1, 1), ("5", "ETH-USD", 13, 2, -1)]
    assert normalise(f, "bitfinex", "trades", dedup_trade_id=True).count() == 4


def test_gemini_best_never_moves_back(spark):
    def m(*changes):
        return {"type": "l2_updates", "symbol": "BTCUSD", "changes": [list(map(str, c)) for c in changes]}

    f = frames(spark, "gemini", m(("buy", 10, 1)), m(("sell", 12, 2)), m(("buy", 9, 5)), m(("buy", 11, 0)),
               m(("buy", 10, 7), ("sell", 11.5, 3)), m())
    for block in (2 * S, 10 ** 15):
        got = [(r["bid_px"], r["bid_sz"], r["ask_px"], r["ask_sz"])
               for r in rows(normalise(f, "gemini", "quotes", block_ns=block), "ts_ns")]
        assert got == [(10, 1, 12, 2), (10, 1, 12, 2), (10, 1, 12, 2), (10, 7, 11.5, 3), (10, 7, 11.5, 3)]


def test_unknown_stream_raises(spark):
    with pytest.raises(KeyError):
        normalise(frames(spark, "okx"), "okx", "funding")


def sequential(events, depth):
    """One book per symbol, all events in order."""
    out = []
    for symbol in sorted({e[0] for e in events}):
        mine = sorted((e for e in events if e[0] == symbol), key=lambda e: e[1:4])
        found, _ = replay({"bid": {}, "ask": {}}, 0, [(e[1], e[4], e[5]) for e in mine], depth)
        out += [(symbol, f["ts_ns"], [x["px"] for x in f["bids"]], [x["px"] for x in f["asks"]]) for f in found]
    return out


def level_events(seed, n=400, prices=12, steps=(0, 50 * MS, 900 * MS, 4 * S, 13 * S), clears=0.02):
    rng = random.Random(seed)
    events, now = [], T
    for i in range(n):
        now += rng.choice(steps)
        ups = [{"side": rng.choice(["bid", "ask", "ask", "bid", "none", None]), "px": rng.choice([float(rng.randrange(prices)), None])
                if rng.random() < 0.1 else float(rng.randrange(prices)), "qty": float(rng.choice([0, 1, 2, 2]))}
               for _ in range(rng.randrange(4))]
        events.append(("hot" if rng.random() < 0.8 else "thin", now, i, 0, rng.random() < clears, None if i % 50 == 3 else ups))
    return events


def blocked(spark, events, depth, block):
    return [(r["symbol"], r["ts_ns"], [x["px"] for x in r["bids"]], [x["px"] for x in r["asks"]])
            for r in rows(rebuild_books(spark.createDataFrame(events, EVENTS).repartition(3), "kraken", depth, block), "symbol", "ts_ns")]


@pytest.mark.parametrize("seed,block,prices,depth", [(1, 1, 12, 5), (2, 7, 60, 2), (3, 50, 200, 3), (4, 1000, 12, 5)])
def test_blocked_books_equal_one_sequential_replay(spark, seed, block, prices, depth):
    events = level_events(seed, prices=prices, clears=0.02 if seed % 2 else 0.0)
    assert blocked(spark, events, depth, block) == sequential(events, depth)


def test_a_symbol_with_all_events_in_one_minute(spark):
    events = level_events(9, n=900, prices=300, steps=(0, 5 * MS, 40 * MS, 60 * MS, 200 * MS), clears=0.0)
    assert blocked(spark, events, 4, 16) == sequential(events, 4)


def test_a_deep_book_starts_blocks_with_what_can_come_to_the_top(spark):
    """300 resting levels, then updates at the top: later blocks start with a few levels, not with the book."""
    events = [("A", T + i * S, i, 0, False, [{"side": "bid", "px": float(i) if i < 300 else 1000.0 + i % 5, "qty": 1.0 + i % 2}])
              for i in range(600)]
    placed = ranked(sorted_blocks(spark.createDataFrame(events, EVENTS).coalesce(1), ["symbol"], ORDER), ["symbol"])
    cut = placed.selectExpr("*", "rank div 4 + 1 as idx").drop("block", "rank", "n")
    alive = levels_at_start(cut, event_blocks(cut, 2)).where("idx > 80")
    assert 0 < max(r["count"] for r in alive.groupBy("idx").count().collect()) <= 2 * 9
    assert blocked(spark, events, 2, 4) == sequential(events, 2)


def test_spans_are_tree_nodes(spark):
    spans = [(a, b, 40) for a in range(1, 41) for b in range(a, 41)]
    found = spark.createDataFrame(spans, "a long, b long, n long").select("a", "b", tree_nodes("a", "b", "n").alias("x")).collect()
    for r in found:
        covered = sorted(i for x in r.x for i in range(x.no << x.height, (x.no + 1) << x.height))
        assert covered == list(range(r.a, r.b + 1)) and len(r.x) <= 12


def test_emission_times_do_not_depend_on_the_cells(spark):
    events = level_events(5, n=600)
    want = sorted((s, f["ts_ns"]) for s in ("hot", "thin") for f in replay(
        {"bid": {}, "ask": {}}, 0, sorted((e[1], False, None) for e in events if e[0] == s), 1)[0])
    df = spark.createDataFrame(events, EVENTS)
    for cell in (S, 20 * S, 3600 * S):
        assert sorted((r.symbol, r.emit_ns) for r in emission_times(df, cell).collect()) == want


def test_kraken_snapshot_clears(spark):
    def m(kind, **sides):
        return {"channel": "book", "type": kind, "data": [{"symbol": "BTC/USD", **{
            k: [{"price": p, "qty": q} for p, q in v] for k, v in sides.items()}}]}

    f = frames(spark, "kraken", m("update", bids=[(1, 1), (2, 1)], asks=[(3, 1)]), *[m("update")] * 5,
               m("snapshot", bids=[(1.5, 2)]))
    got = rows(rebuild_books(kraken_level_events(f), "kraken", 10), "ts_ns")
    assert [[x["px"] for x in r["bids"]] for r in got] == [[2, 1], [2, 1]]
    later = rows(rebuild_books(kraken_level_events(frames(
        spark, "kraken", m("update", bids=[(1, 1)]), *[m("update")] * 4, m("snapshot", bids=[(1.5, 2)]))), "kraken", 10),
        "ts_ns")
    assert [[x["px"] for x in r["bids"]] for r in later] == [[1], [1.5]]
