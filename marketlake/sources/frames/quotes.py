"""Best bid/ask messages and ready-made book snapshots, one parser per venue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.ordered import running_best
from marketlake.functions.timeutil import MINUTE, MS, idiv
from marketlake.session import shared_dir
from marketlake.sources.frames.common import (LIST, OBJECT, cell, iso_ns, jlist, jtable, ms_ns, msg, num, of_venue, once,
                                              present, quote_rows, recv_ms_ns, rows_as, top_of_book,
                                              with_channel)
from marketlake.sources.frames.trades import bitstamp_ns, coinbase_events, event_items, field, items, kraken_symbol, unwrapped
from marketlake.sources.store import materialize
from marketlake.sources.venues import canonical_of

TABLE = "array<array<string>>"
# Book depths the venue offers.
BINANCE_DEPTHS = (5, 10, 20)


def binance(frames: DataFrame) -> DataFrame:
    """No exchange time in the message: one millisecond before receipt stands in."""
    df = unwrapped(frames, "binance")
    return quote_rows(df, "binance", field("s", "d"), ts_ns=F.col("recv_ns") - MS, bid_px=num(field("b", "d")),
                      ask_px=num(field("a", "d")), bid_sz=num(field("B", "d")), ask_sz=num(field("A", "d")))


def coinbase(frames: DataFrame) -> DataFrame:
    df = event_items(coinbase_events(frames, "ticker"), "tickers")

    def or_zero(*keys: str) -> Column:
        return F.coalesce(num(F.coalesce(*[present(field(k)) for k in keys])), F.lit(0.0))

    return quote_rows(df, "coinbase", field("product_id"),
                      ts_ns=F.coalesce(iso_ns(present(F.col("m.timestamp"))), F.col("recv_ns")),
                      bid_px=or_zero("best_bid", "price"), ask_px=or_zero("best_ask", "price"),
                      bid_sz=or_zero("best_bid_quantity"), ask_sz=or_zero("best_ask_quantity"))


def kraken(frames: DataFrame) -> DataFrame:
    df = items(of_venue(frames, "kraken", channel="string", data=LIST).where(msg("channel") == "ticker"))

    def or_zero(key: str) -> Column:
        return F.coalesce(num(field(key)), F.lit(0.0))

    return quote_rows(df, "kraken", symbol=kraken_symbol(field("symbol")), ts_ns=F.col("recv_ns"),
                      bid_px=or_zero("bid"), ask_px=or_zero("ask"), bid_sz=or_zero("bid_qty"),
                      ask_sz=or_zero("ask_qty"))


def bybit(frames: DataFrame) -> DataFrame:
    topic = F.startswith(msg("topic"), F.lit("orderbook.1."))
    df = of_venue(frames, "bybit", topic="string", ts="string",
                  data=f"struct<s:string,b:{TABLE},a:{TABLE}>").where(topic)
    return quote_rows(df, "bybit", msg("data")["s"], ts_ns=F.coalesce(ms_ns(msg("ts")), recv_ms_ns()),
                      **top_of_book(msg("data")["b"], msg("data")["a"]))


def okx(frames: DataFrame) -> DataFrame:
    df = of_venue(frames, "okx", arg=OBJECT, data=f"array<struct<ts:string,bids:{TABLE},asks:{TABLE}>>")
    df = items(df.where(msg("arg")["channel"] == "bbo-tbt"))
    return quote_rows(df, "okx", msg("arg")["instId"], ts_ns=ms_ns(field("ts")),
                      **top_of_book(field("bids"), field("asks")))


def bitstamp(frames: DataFrame) -> DataFrame:
    df = of_venue(frames, "bitstamp", event="string", channel="string",
                  data=f"struct<timestamp:string,microtimestamp:string,bids:{TABLE},asks:{TABLE}>")
    df = df.where(msg("event") == "data").withColumn("d", msg("data"))
    native = F.replace(msg("channel"), F.lit("order_book_"), F.lit(""))
    return quote_rows(df, "bitstamp", native, ts_ns=bitstamp_ns(),
                      **top_of_book(field("bids", "d"), field("asks", "d")))


def bitfinex(frames: DataFrame) -> DataFrame:
    df = once(with_channel(frames, "bitfinex", "ticker"), "t", jlist(cell(F.col("parts"), 1)))
    df = df.where(F.size("t") >= 4)
    t = F.col("t")
    return quote_rows(df, "bitfinex", symbol=F.col("symbol"), ts_ns=F.col("recv_ns"), bid_px=num(cell(t, 0)),
                      bid_sz=num(cell(t, 1)), ask_px=num(cell(t, 2)), ask_sz=num(cell(t, 3)))


def gemini_changes(frames: DataFrame) -> DataFrame:
    """Per update message the best non-empty bid and ask among its own changes.

    Orderings are plain maxima: a bid by (price, position), an ask by (−price, position);
    on equal prices the later change wins.
    """
    df = of_venue(frames, "gemini", type="string", symbol="string", changes=TABLE).where(msg("type") == "l2_updates")
    table = F.coalesce(msg("changes"), F.array().cast(TABLE))
    changes = F.transform(table, lambda x, i: F.struct(
        F.get(x, F.lit(0)).alias("side"), F.get(x, F.lit(1)).try_cast("double").alias("px"),
        F.get(x, F.lit(2)).try_cast("double").alias("qty"), i.alias("i")))

    def best(side: str, sign: int) -> Column:
        mine = F.filter("_changes", lambda x: (x["side"] == side) & (x["qty"] != 0))
        return F.array_max(F.transform(mine, lambda x: F.struct(
            (x["px"] * sign).alias("k"), F.col("recv_ns").alias("r"), F.col("seq").alias("s"),
            x["i"].alias("i"), x["qty"].alias("qty"))))

    df = once(df, "_changes", changes).withColumn("symbol", canonical_of(msg("symbol"), "gemini"))
    return df.select("recv_ns", "seq", "symbol",
                     best("buy", 1).alias("bid"), best("sell", -1).alias("ask")).where(F.col("symbol").isNotNull())


def gemini(frames: DataFrame, block_ns: int = 10 * MINUTE) -> DataFrame:
    """Best prices ever seen, one quote per message once both sides are known. The best
    never moves away again, because emptied levels are ignored. Messages are decoded once, into a scratch copy of
    each one's own best, since the running best reads them twice."""
    changes = materialize(gemini_changes(frames).withColumnsRenamed({"bid": "b", "ask": "a"}),
                          shared_dir(frames.sparkSession, "gemini"))
    running = running_best(changes, ["symbol"], ["recv_ns", "seq"], {"best_bid": F.col("b"), "best_ask": F.col("a")},
                           idiv(F.col("recv_ns"), block_ns))
    return gemini_quotes(running)


def gemini_quotes(running: DataFrame) -> DataFrame:
    bid, ask = F.col("best_bid.k"), -F.col("best_ask.k")
    return quote_rows(running.where((bid > 0) & (ask > 0)), "gemini", symbol=F.col("symbol"), ts_ns=F.col("recv_ns"),
                      bid_px=bid, ask_px=ask, bid_sz=F.col("best_bid.qty"), ask_sz=F.col("best_ask.qty"))


def binance_book(frames: DataFrame, depth: int = 20) -> DataFrame:
    """Partial books at the smallest offered depth that covers the request."""
    offered = next((d for d in BINANCE_DEPTHS if d >= depth), BINANCE_DEPTHS[-1])
    df = unwrapped(frames, "binance").where(F.contains(msg("stream"), F.lit("@")))
    native = F.get(F.split(msg("stream"), "@"), F.lit(0))

    def ladder(key: str) -> Column:
        return F.transform(jtable(field(key, "d")), lambda x: F.struct(
            F.get(x, F.lit(0)).try_cast("double").alias("px"), F.get(x, F.lit(1)).try_cast("double").alias("sz")))

    return rows_as(df, "book_l2_snapshot", "binance", ("bids", "asks"), ts_ns=F.col("recv_ns"),
                   symbol=canonical_of(native, "binance"), depth=F.lit(offered), bids=ladder("bids"),
                   asks=ladder("asks"))


PARSERS = {"binance": binance, "coinbase": coinbase, "kraken": kraken, "bybit": bybit, "okx": okx,
           "bitstamp": bitstamp, "gemini": gemini, "bitfinex": bitfinex}
