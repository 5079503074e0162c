"""Trade messages, one parser per venue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.sources.frames.common import (LIST, OBJECT, buy_or_sell, cell, iso_ns, jlist, jmap, jtable, ms_ns,
                                              msg, num, of_venue, once, present, recv_ms_ns, trade_rows, whole,
                                              with_channel)
from marketlake.sources.venues import listing, lookup

COINBASE = ("channel string, timestamp string, events array<struct<trades:array<map<string,string>>,"
            "tickers:array<map<string,string>>,product_id:string,updates:array<map<string,string>>>>")


def unwrapped(frames: DataFrame, venue: str) -> DataFrame:
    """Combined-stream messages wrap their payload in ``data``; single streams do not."""
    df = of_venue(frames, venue, stream="string", data=OBJECT)
    wrapped = F.when(F.size(msg("data")) > 0, msg("data"))
    return once(df, "d", F.coalesce(wrapped, jmap("raw")))


def items(df: DataFrame) -> DataFrame:
    """One row per object of the message's ``data``, in ``t``, with its place there."""
    return df.withColumn("_list", msg("data")).select("*", F.posexplode("_list").alias("_event", "t"))


def field(key: str, of: str = "t") -> Column:
    return F.col(of)[key]


def text_id(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def binance(frames: DataFrame) -> DataFrame:
    df = unwrapped(frames, "binance").where(field("e", "d") == "trade")
    return trade_rows(df, "binance", field("s", "d"), ts_ns=ms_ns(field("T", "d")), price=num(field("p", "d")),
                      size=num(field("q", "d")), side=F.when(field("m", "d") == "true", -1).otherwise(1),
                      trade_id=field("t", "d"))


def coinbase_events(frames: DataFrame, channel: str) -> DataFrame:
    return (once(frames.where(F.col("venue") == "coinbase"), "m", F.from_json("raw", COINBASE))
            .where(F.col("m.channel") == channel)
            .select("*", F.posexplode("m.events").alias("event_no", "ev")))


def event_items(events: DataFrame, name: str) -> DataFrame:
    """One row per object of an event's list, in ``t``, with its place in the message."""
    items = events.select("*", F.posexplode(f"ev.{name}").alias("_item", "t"))
    return items.withColumn("_event", F.shiftleft(F.col("event_no").cast("long"), 32) + F.col("_item"))


def coinbase(frames: DataFrame) -> DataFrame:
    df = event_items(coinbase_events(frames, "market_trades"), "trades")
    return trade_rows(df, "coinbase", field("product_id"), ts_ns=iso_ns(field("time")), price=num(field("price")),
                      size=num(field("size")), side=buy_or_sell(F.upper(field("side")) == "BUY"),
                      trade_id=text_id(field("trade_id")))


def kraken_symbol(pair: Column) -> Column:
    """Socket pairs are BASE/QUOTE (or joined), unlike the tickers of the listing."""
    pairs = {c.replace("-", ""): c for c in listing().tickers("kraken").values()}
    return lookup(pairs, F.replace(pair, F.lit("/"), F.lit("")))


def kraken(frames: DataFrame) -> DataFrame:
    df = items(of_venue(frames, "kraken", channel="string", data=LIST).where(msg("channel") == "trade"))
    return trade_rows(df, "kraken", symbol=kraken_symbol(field("symbol")), ts_ns=iso_ns(field("timestamp")),
                      price=num(field("price")), size=num(field("qty")), side=buy_or_sell(field("side") == "buy"),
                      trade_id=text_id(field("trade_id")))


def bybit(frames: DataFrame) -> DataFrame:
    topic = F.startswith(msg("topic"), F.lit("publicTrade."))
    df = items(of_venue(frames, "bybit", topic="string", data=LIST).where(topic))
    return trade_rows(df, "bybit", field("s"), ts_ns=ms_ns(field("T")), price=num(field("p")), size=num(field("v")),
                      side=buy_or_sell(field("S") == "Buy"), trade_id=text_id(field("i")))


def okx(frames: DataFrame) -> DataFrame:
    df = items(of_venue(frames, "okx", arg=OBJECT, data=LIST).where(msg("arg")["channel"] == "trades"))
    return trade_rows(df, "okx", field("instId"), ts_ns=ms_ns(field("ts")), price=num(field("px")),
                      size=num(field("sz")), side=buy_or_sell(field("side") == "buy"),
                      trade_id=text_id(field("tradeId")))


def bitstamp_ns(d: str = "d") -> Column:
    """Microseconds where given, else whole seconds."""
    seconds = F.coalesce(whole(field("timestamp", d)), F.lit(0)) * 1000000
    return F.coalesce(whole(present(field("microtimestamp", d))), seconds) * 1000


def bitstamp(frames: DataFrame) -> DataFrame:
    df = of_venue(frames, "bitstamp", event="string", channel="string", data=OBJECT).where(
        msg("event") == "trade").withColumn("d", msg("data"))
    native = F.replace(msg("channel"), F.lit("live_trades_"), F.lit(""))
    bought = F.coalesce(whole(field("type", "d")), F.lit(0)) == 0
    return trade_rows(df, "bitstamp", native, ts_ns=bitstamp_ns(), price=num(field("price", "d")),
                      size=num(field("amount", "d")), side=buy_or_sell(bought), trade_id=text_id(field("id", "d")))


def gemini(frames: DataFrame) -> DataFrame:
    names = ("type", "symbol", "event_id", "timestamp", "price", "quantity", "side")
    df = of_venue(frames, "gemini", **dict.fromkeys(names, "string")).where(msg("type") == "trade")
    return trade_rows(df, "gemini", msg("symbol"), ts_ns=F.coalesce(ms_ns(msg("timestamp")), recv_ms_ns()),
                      price=num(msg("price")), size=num(msg("quantity")),
                      side=buy_or_sell(F.lower(msg("side")) == "buy"), trade_id=text_id(msg("event_id")))


def bitfinex(frames: DataFrame, dedup_trade_id: bool = False) -> DataFrame:
    """Every print arrives as ``te`` and again as ``tu``; both count unless asked otherwise."""
    df = with_channel(frames, "bitfinex", "trades")
    parts = F.col("parts")
    second, payload = cell(parts, 1), F.coalesce(cell(parts, 2), cell(parts, 1))
    listed = F.startswith(second, F.lit("["))
    many = F.startswith(payload, F.lit("[["))
    rows = F.when(many, jtable(payload)).otherwise(F.array(jlist(payload)))
    df = (once(df.where(listed | second.isin("te", "tu")), "_list", rows).select("*", F.posexplode("_list").alias("_event", "t"))
          .where(F.size("t") >= 4))
    amount = num(cell(F.col("t"), 2))
    out = trade_rows(df, "bitfinex", symbol=F.col("symbol"), ts_ns=ms_ns(cell(F.col("t"), 1)),
                     price=num(cell(F.col("t"), 3)), size=F.abs(amount), side=buy_or_sell(amount > 0),
                     trade_id=cell(F.col("t"), 0))
    return out.dropDuplicates(["symbol", "trade_id"]) if dedup_trade_id else out


PARSERS = {"binance": binance, "coinbase": coinbase, "kraken": kraken, "bybit": bybit, "okx": okx,
           "bitstamp": bitstamp, "gemini": gemini, "bitfinex": bitfinex}
