"""Venue messages rendered from the market-shaped views: the views' rows, one message
each, in the venue's wire format. Symbol SYM2 becomes an unlisted ticker and every
97th message is cut short, so that both drop rules show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timeutil import MS, SECOND, US, idiv, ts_of

# Wire tickers of SYM0, SYM1 and SYM2 per venue; the last is listed nowhere.
TICKERS = {
    "binance": ("BTCUSDT", "ETHUSDT", "ZZZUSDT"), "binance_futures": ("BTCUSDT", "ETHUSDT", "ZZZUSDT"),
    "coinbase": ("BTC-USD", "ETH-USD", "ZZZ-USD"), "kraken": ("BTC/USD", "ETHUSDT", "ZZZ/USD"),
    "bybit": ("BTCUSDT", "SOLUSDT", "ZZZUSDT"), "okx": ("BTC-USDT", "ETH-USDT", "ZZZ-USDT"),
    "bitstamp": ("btcusdt", "ethusd", "zzzusd"), "gemini": ("BTCUSDT", "ethusd", "zzzusd"),
    "bitfinex": ("tBTCUSD", "tETHUST", "tZZZUSD"),
}
CANONICAL = {
    "binance": ("BTC-USDT", "ETH-USDT"), "binance_futures": ("BTC-USDT-PERP", "ETH-USDT-PERP"),
    "coinbase": ("BTC-USD", "ETH-USD"), "kraken": ("BTC-USD", "ETH-USDT"),
    "bybit": ("BTC-USDT-PERP", "SOL-USDT-PERP"), "okx": ("BTC-USDT", "ETH-USDT"),
    "bitstamp": ("BTC-USDT", "ETH-USD"), "gemini": ("BTC-USDT", "ETH-USD"), "bitfinex": ("BTC-USD", "ETH-USDT"),
}

TRADE_TEXT = {
    "binance": '{"stream":"x@trade","data":{"e":"trade","E":1,"s":"%1$s","t":%2$s,"p":"%3$s","q":"%4$s","T":%5$d,'
               '"m":%8$s,"M":true}}',
    "coinbase": '{"channel":"market_trades","events":[{"trades":[{"trade_id":"%2$s","product_id":"%1$s",'
                '"price":"%3$s","size":"%4$s","side":"%7$s","time":"%6$s"}]},{"trades":[]}]}',
    "kraken": '{"channel":"trade","data":[{"symbol":"%1$s","side":"%7$s","price":%3$s,"qty":%4$s,"trade_id":%2$s,'
              '"timestamp":"%6$s"}]}',
    "bybit": '{"topic":"publicTrade.x","data":[{"T":%5$d,"s":"%1$s","S":"%9$s","v":"%4$s","p":"%3$s","i":"%2$s"}]}',
    "okx": '{"arg":{"channel":"trades","instId":"%1$s"},"data":[{"instId":"%1$s","tradeId":"%2$s","px":"%3$s",'
           '"sz":"%4$s","side":"%7$s","ts":"%5$d"}]}',
    "bitstamp": '{"event":"trade","channel":"live_trades_%1$s","data":{"id":%2$s,"microtimestamp":"%10$d",'
                '"amount":%4$s,"price":%3$s,"type":%11$d}}',
    "gemini": '{"type":"trade","symbol":"%1$s","event_id":%2$s,"timestamp":%5$d,"price":"%3$s","quantity":"%4$s",'
              '"side":"%7$s"}',
    "bitfinex": '[%12$d,"te",[%2$s,%5$d,%13$s%4$s,%3$s]]',
}
QUOTE_TEXT = {
    "binance": '{"stream":"x@bookTicker","data":{"s":"%1$s","b":"%2$s","B":"%3$s","a":"%4$s","A":"%5$s"}}',
    "coinbase": '{"channel":"ticker","timestamp":"%7$s","events":[{"tickers":[{"product_id":"%1$s","price":"%2$s",'
                '"best_bid":"","best_ask":"%4$s","best_bid_quantity":"%3$s"}]}]}',
    "kraken": '{"channel":"ticker","data":[{"symbol":"%1$s","bid":%2$s,"bid_qty":%3$s,"ask":%4$s}]}',
    "bybit": '{"topic":"orderbook.1.x","ts":%6$d,"data":{"s":"%1$s","b":[["%2$s","%3$s"]],"a":[["%4$s","%5$s"]]}}',
    "okx": '{"arg":{"channel":"bbo-tbt","instId":"%1$s"},"data":[{"bids":[["%2$s","%3$s","0"]],'
           '"asks":[["%4$s","%5$s","0"]],"ts":"%6$d"},{"bids":[],"asks":[],"ts":"1"}]}',
    "bitstamp": '{"event":"data","channel":"order_book_%1$s","data":{"timestamp":"%8$d","bids":[["%2$s","%3$s"]],'
                '"asks":[["%4$s","%5$s"]]}}',
    "gemini": '{"type":"l2_updates","symbol":"%1$s","changes":[["buy","%2$s","%3$s"],["buy","999","0"],'
              '["sell","%4$s","%5$s"]]}',
    "bitfinex": '[%9$d,[%2$s,%3$s,%4$s,%5$s,0,0]]',
}


def ticker(venue: str) -> Column:
    names = TICKERS[venue]
    return (F.when(F.col("symbol") == "SYM0", names[0]).when(F.col("symbol") == "SYM1", names[1])
            .otherwise(names[2]))


def channel_no() -> Column:
    return F.expr("10 + CAST(substring(symbol, 4) AS INT)")


def _iso(c: str = "ts_ns") -> Column:
    return F.date_format(ts_of(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _frames(rows: DataFrame, venue: str, raw: Column) -> DataFrame:
    cut = F.when(F.col("seq") % 97 == 0, F.expr("substring(_raw, 1, length(_raw) - 3)")).otherwise(F.col("_raw"))
    return (rows.withColumn("_raw", raw)
            .select(F.concat(F.lit("c"), (F.col("seq") % 4).cast("string")).alias("conn_id"), "seq", "recv_ns",
                    F.lit(venue).alias("venue"), cut.alias("raw")))


def _subscriptions(rows: DataFrame, channel: str) -> DataFrame:
    """Each connection names its channels before its first data message."""
    text = F.format_string('{"event":"subscribed","channel":"%s","chanId":%d,"symbol":"%s","pair":"x"}',
                           F.lit(channel), channel_no(), ticker("bitfinex"))
    return (rows.select("symbol", (F.col("seq") % 4).alias("c")).distinct()
            .select(F.concat(F.lit("c"), F.col("c").cast("string")).alias("conn_id"),
                    F.lit(-1).cast("long").alias("seq"), F.lit(0).cast("long").alias("recv_ns"),
                    F.lit("bitfinex").alias("venue"), text.alias("raw")))


def trade_frames(trades: DataFrame, venue: str) -> DataFrame:
    buy = F.col("side") == 1
    raw = F.format_string(
        TRADE_TEXT[venue], ticker(venue), F.col("seq").cast("string"), F.col("price").cast("string"),
        F.col("size").cast("string"), idiv(F.col("ts_ns"), MS), _iso(),
        F.when(buy, "buy").otherwise("sell"), F.when(buy, "false").otherwise("true"),
        F.when(buy, "Buy").otherwise("Sell"), idiv(F.col("ts_ns"), US), F.when(buy, 0).otherwise(1), channel_no(),
        F.when(buy, "").otherwise("-"))
    frames = _frames(trades, venue, raw)
    return frames.unionByName(_subscriptions(trades, "trades")) if venue == "bitfinex" else frames


def quote_frames(quotes: DataFrame, venue: str) -> DataFrame:
    raw = F.format_string(
        QUOTE_TEXT[venue], ticker(venue), *[F.col(c).cast("string") for c in ("bid_px", "bid_sz", "ask_px", "ask_sz")],
        idiv(F.col("ts_ns"), MS), _iso(), idiv(F.col("ts_ns"), SECOND), channel_no())
    frames = _frames(quotes, venue, raw)
    return frames.unionByName(_subscriptions(quotes, "ticker")) if venue == "bitfinex" else frames


def funding_frames(trades: DataFrame, venue: str) -> DataFrame:
    if venue == "bybit":
        # every fifth update carries no rate, every third no settlement time
        raw = F.format_string(
            '{"topic":"tickers.x","ts":%d,"data":{"symbol":"%s"%s,"markPrice":"%s","nextFundingTime":"%s"}}',
            idiv(F.col("ts_ns"), MS), ticker(venue),
            F.when(F.col("seq") % 5 == 0, "").otherwise(
                F.concat(F.lit(',"fundingRate":"'), F.col("size").cast("string"), F.lit('"'))),
            F.col("price").cast("string"),
            F.when(F.col("seq") % 3 == 0, "0").otherwise(idiv(F.col("recv_ns"), MS).cast("string")))
    else:
        raw = F.format_string(
            '{"stream":"x","data":{"e":"markPriceUpdate","E":%d,"s":"%s","p":"%s","r":"%s","T":%d}}',
            idiv(F.col("ts_ns"), MS), ticker(venue), F.col("price").cast("string"), F.col("size").cast("string"),
            idiv(F.col("recv_ns"), MS))
    return _frames(trades, venue, raw)


def oi_frames(trades: DataFrame, venue: str) -> DataFrame:
    text = ('{"result":{"symbol":"%2$s","list":[{"openInterest":"%3$s","timestamp":"%1$d"},{"openInterest":"1"}]}}'
            if venue == "bybit" else '{"symbol":"%2$s","openInterest":"%3$s","time":%1$d}')
    return _frames(trades, venue, F.format_string(text, idiv(F.col("ts_ns"), MS), ticker(venue),
                                                  F.col("price").cast("string")))


def depth_frames(books: DataFrame) -> DataFrame:
    side = "concat('[', array_join(transform({s}, x -> concat('[\"', string(x.px), '\",\"', string(x.sz), '\"]')), ','), ']')"
    return _frames(books, "binance", F.format_string(
        '{"stream":"%s@depth5@100ms","data":{"bids":%s,"asks":%s}}', F.lower(ticker("binance")),
        F.expr(side.format(s="bids")), F.expr(side.format(s="asks"))))


def level2_frames(trades: DataFrame, venue: str) -> DataFrame:
    """Level updates: price on a coarse grid, size zero (a deletion) now and then; for the
    venue that sends snapshots every 400th message is one."""
    px = F.round("price", 1).cast("string")
    side = F.when(F.col("seq") % 2 == 0, "bid").otherwise("offer" if venue == "coinbase" else "ask")
    if venue == "coinbase":
        raw = F.format_string('{"channel":"l2_data","events":[{"product_id":"%s","updates":[{"side":"%s",'
                              '"price_level":"%s","new_quantity":"%s"}]}]}', ticker(venue), side, px,
                              F.col("size").cast("string"))
    else:
        raw = F.format_string('{"channel":"book","type":"%s","data":[{"symbol":"%s","%ss":[{"price":%s,"qty":%s}]}]}',
                              F.when(F.col("seq") % 400 == 0, "snapshot").otherwise("update"), ticker(venue), side,
                              px, F.col("size").cast("string"))
    return _frames(trades, venue, raw)


# ---- REST pages: one page per (symbol, 5 s), rows in the venue's shape ----

TRADE_ROW = {
    "binance": '{"a":%2$s,"p":"%3$s","q":"%4$s","T":%5$d,"m":%8$s}',
    "coinbase": '{"time":"%6$s","trade_id":%2$s,"price":"%3$s","size":"%4$s","side":"%7$s"}',
    "kraken": '["%3$s","%4$s",%14$s,"%15$s","m","",%2$s]',
    "bybit": '{"execId":"%2$s","price":"%3$s","size":"%4$s","side":"%9$s","time":"%5$d"}',
    "okx": '{"tradeId":"%2$s","px":"%3$s","sz":"%4$s","side":"%7$s","ts":"%5$d"}',
    "bitstamp": '{"date":"%16$d","tid":"%2$s","price":"%3$s","amount":"%4$s","type":"%11$d"}',
    "gemini": '{"timestampms":%5$d,"tid":%2$s,"price":"%3$s","amount":"%4$s","type":"%7$s"}',
    "bitfinex": '[%2$s,%5$d,%13$s%4$s,%3$s]',
}
KLINE_ROW = {
    "binance": '[%1$d,"%2$s","%3$s","%4$s","%5$s","%6$s",0,"0",%7$d]',
    "binance_futures": '[%1$d,"%2$s","%3$s","%4$s","%5$s","%6$s",0,"0",%7$d]',
    "coinbase": '[%8$d,%4$s,%3$s,%2$s,%5$s,%6$s]',
    "kraken": '[%8$d,"%2$s","%3$s","%4$s","%5$s","0","%6$s",%7$d]',
    "bybit": '["%1$d","%2$s","%3$s","%4$s","%5$s","%6$s"]',
    "okx": '["%1$d","%2$s","%3$s","%4$s","%5$s","%6$s"]',
    "bitstamp": '{"timestamp":"%8$d","open":"%2$s","high":"%3$s","low":"%4$s","close":"%5$s","volume":"%6$s"}',
    "gemini": '[%1$d,%2$s,%3$s,%4$s,%5$s,%6$s]',
    "bitfinex": '[%1$d,%2$s,%5$s,%3$s,%4$s,%6$s]',
}
_WRAP = {"kraken": ('{"error":[],"result":{"XXBTZUSD":[', '],"last":"9"}}'), "bybit": ('{"result":{"list":[', ']}}'),
         "okx": ('{"data":[', ']}')}


def _page(rows: DataFrame, venue: str, item: Column, wrap: tuple[str, str], span_ns: int) -> DataFrame:
    """Pages ask for the middle of their span, so that the window bounds have rows to cut. As
    with real pages, none holds more than a thousand rows: the row number decides its page."""
    start = F.col("ts_ns") - F.pmod("ts_ns", F.lit(span_ns))
    number = idiv(F.col("seq"), 1000) if "seq" in rows.columns else F.lit(0)
    return (rows.withColumn("item", item).groupBy("symbol", start.alias("page_ns"), number.alias("_no"))
            .agg(F.array_join(F.array_sort(F.collect_list("item")), ",").alias("body"))
            .select(F.lit(venue).alias("venue"), "symbol", (F.col("page_ns") + span_ns // 5).alias("start_ns"),
                    (F.col("page_ns") + span_ns // 5 * 3).alias("end_ns"),
                    F.concat(F.lit(wrap[0]), "body", F.lit(wrap[1])).alias("raw")))


PAGE_NS = 5 * SECOND


def trade_pages(trades: DataFrame, venue: str) -> DataFrame:
    buy = F.col("side") == 1
    item = F.format_string(
        TRADE_ROW[venue], F.lit(""), F.col("seq").cast("string"), F.col("price").cast("string"),
        F.col("size").cast("string"), idiv(F.col("ts_ns"), MS), _iso(), F.when(buy, "buy").otherwise("sell"),
        F.when(buy, "false").otherwise("true"), F.when(buy, "Buy").otherwise("Sell"), F.lit(0),
        F.when(buy, 0).otherwise(1), F.lit(0), F.when(buy, "").otherwise("-"),
        F.concat(idiv(F.col("ts_ns"), SECOND).cast("string"), F.lit(".0")), F.when(buy, "b").otherwise("s"),
        idiv(F.col("ts_ns"), SECOND))
    return _page(trades, venue, item, _WRAP.get(venue, ("[", "]")), PAGE_NS)


def funding_pages(trades: DataFrame, venue: str) -> DataFrame:
    key = "fundingTime" if venue == "binance_futures" else "fundingRateTimestamp"
    item = F.format_string(f'{{"{key}":%d,"fundingRate":"%s"}}', idiv(F.col("ts_ns"), MS), F.col("size").cast("string"))
    return _page(trades, venue, item, _WRAP["bybit"] if venue == "bybit" else ("[", "]"), PAGE_NS)


def kline_pages(bars: DataFrame, venue: str) -> DataFrame:
    wrap = {**_WRAP, "bitstamp": ('{"data":{"pair":"x","ohlc":[', ']}}')}.get(venue, ("[", "]"))
    prices = [F.round(c, 6).cast("string") for c in ("open", "high", "low", "close", "volume")]
    item = F.format_string(KLINE_ROW[venue], idiv(F.col("ts_ns"), MS), *prices, F.col("trades"),
                           idiv(F.col("ts_ns"), SECOND))
    return _page(bars, venue, item, wrap, 60 * SECOND)
