"""Landed REST pages → trades, funding and klines.

A page row carries ``venue, symbol, start_ns, end_ns, raw``: the canonical symbol
asked for, the window asked for, and the response text. The venues differ in shape
and in which ends of the window they leave to the reader, so both are data here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timeutil import MS, SECOND, floor_ns
from marketlake.sources.frames.common import (buy_or_sell, cell, iso_ns, jmap, jmaps, jtable, ms_ns, num, once, rows_as,
                                              trade_rows, whole)
from marketlake.sources.frames.trades import field, text_id

PAGES = "venue string, symbol string, start_ns long, end_ns long, raw string"


def _under(*keys: str) -> Column:
    """Text of a nested member of the response."""
    out = F.col("raw")
    for key in keys:
        out = jmap(out)[key]
    return out


def _pair_list() -> Column:
    """The one member of ``result`` that is not the cursor."""
    return F.get(F.map_values(F.map_filter(jmap(_under("result")), lambda k, _: k != "last")), F.lit(0))


def _window(df: DataFrame, ends: str) -> DataFrame:
    """``ends``: which bounds the reader applies; the end is inclusive."""
    if "start" in ends:
        df = df.where(F.col("ts_ns") >= F.col("_start"))
    if "end" in ends:
        df = df.where(F.col("ts_ns") <= F.col("_end"))
    return df


# Per venue the place of the rows, their shape, and the bounds the reader applies.
TRADE_PAGES = {
    "binance": ((), "maps", ""), "coinbase": ((), "maps", "start end"), "kraken": ("pair", "table", "end"),
    "bybit": (("result", "list"), "maps", ""), "okx": (("data",), "maps", "start end"),
    "bitstamp": ((), "maps", "start end"), "gemini": ((), "maps", "start end"), "bitfinex": ((), "table", "end"),
}


def _trade_columns(venue: str) -> dict[str, Column]:
    t = F.col("t")
    if venue == "binance":
        return {"ts_ns": ms_ns(t["T"]), "price": num(t["p"]), "size": num(t["q"]),
                "side": F.when(t["m"] == "true", -1).otherwise(1), "trade_id": t["a"]}
    if venue == "coinbase":
        return {"ts_ns": iso_ns(t["time"]), "price": num(t["price"]), "size": num(t["size"]),
                "side": buy_or_sell(F.upper(t["side"]) == "BUY"), "trade_id": text_id(t["trade_id"])}
    if venue == "kraken":
        return {"ts_ns": (num(cell(t, 2)) * 1e9).cast("long"), "price": num(cell(t, 0)), "size": num(cell(t, 1)),
                "side": buy_or_sell(cell(t, 3) == "b"), "trade_id": cell(t, 6)}
    if venue == "bybit":
        return {"ts_ns": ms_ns(t["time"]), "price": num(t["price"]), "size": num(t["size"]),
                "side": buy_or_sell(t["side"] == "Buy"), "trade_id": text_id(t["execId"])}
    if venue == "okx":
        return {"ts_ns": ms_ns(t["ts"]), "price": num(t["px"]), "size": num(t["sz"]),
                "side": buy_or_sell(t["side"] == "buy"), "trade_id": text_id(t["tradeId"])}
    if venue == "bitstamp":
        return {"ts_ns": whole(t["date"]) * SECOND, "price": num(t["price"]), "size": num(t["amount"]),
                "side": buy_or_sell(F.coalesce(whole(t["type"]), F.lit(0)) == 0), "trade_id": text_id(t["tid"])}
    if venue == "gemini":
        return {"ts_ns": ms_ns(t["timestampms"]), "price": num(t["price"]), "size": num(t["amount"]),
                "side": buy_or_sell(F.lower(t["type"]) == "buy"), "trade_id": text_id(t["tid"])}
    amount = num(cell(t, 2))
    return {"ts_ns": ms_ns(cell(t, 1)), "price": num(cell(t, 3)), "size": F.abs(amount),
            "side": buy_or_sell(amount > 0), "trade_id": cell(t, 0)}


def _exploded(pages: DataFrame, venue: str, place, shape: str) -> DataFrame:
    text = _pair_list() if place == "pair" else _under(*place)
    df = once(pages.where(F.col("venue") == venue), "text", text)
    return once(df, "_list", jmaps("text") if shape == "maps" else jtable("text")).withColumn(
        "t", F.explode("_list"))


def rest_trades(pages: DataFrame, venue: str) -> DataFrame:
    """History pages carry no receive time of their own; the trade time stands in."""
    place, shape, ends = TRADE_PAGES[venue]
    columns = _trade_columns(venue)
    df = (_exploded(pages, venue, place, shape).withColumn("ts_ns", columns.pop("ts_ns"))
          .withColumnsRenamed({"start_ns": "_start", "end_ns": "_end"}))
    return trade_rows(_window(df, ends), venue, symbol=F.col("symbol"), ts_ns=F.col("ts_ns"),
                      recv_ns=F.col("ts_ns"), **columns)


def rest_funding(pages: DataFrame, venue: str) -> DataFrame:
    place, stamp = {"binance_futures": ((), "fundingTime"),
                    "bybit": (("result", "list"), "fundingRateTimestamp")}[venue]
    df = _exploded(pages, venue, place, "maps").withColumn("ts_ns", ms_ns(field(stamp)))
    return rows_as(df, "funding", venue, ("funding_rate",), ts_ns=F.col("ts_ns"), recv_ns=F.col("ts_ns"),
                   symbol=F.col("symbol"), funding_rate=num(field("fundingRate")))


# Per venue the place of the rows, the unit of their time, the positions (or
# names) of time, open, high, low, close, volume and trade count, and the bounds applied.
KLINE_PAGES = {
    "binance": ((), MS, (0, 1, 2, 3, 4, 5, 8), ""),
    "binance_futures": ((), MS, (0, 1, 2, 3, 4, 5, 8), ""),
    "coinbase": ((), SECOND, (0, 3, 2, 1, 4, 5, None), ""),
    "kraken": ("pair", SECOND, (0, 1, 2, 3, 4, 6, 7), "start end"),
    "bybit": (("result", "list"), MS, (0, 1, 2, 3, 4, 5, None), ""),
    "okx": (("data",), MS, (0, 1, 2, 3, 4, 5, None), "start"),
    "bitstamp": (("data", "ohlc"), SECOND, ("timestamp", "open", "high", "low", "close", "volume", None), ""),
    "gemini": ((), MS, (0, 1, 2, 3, 4, 5, None), "start end"),
    "bitfinex": ((), MS, (0, 1, 3, 4, 2, 5, None), "end"),
}


def rest_klines(pages: DataFrame, venue: str) -> DataFrame:
    """Klines as (ts_ns, symbol, venue, OHLC, volume, trades); an unpublished count is 0."""
    place, unit, at, ends = KLINE_PAGES[venue]
    named = isinstance(at[0], str)
    df = _exploded(pages, venue, place, "maps" if named else "table")

    def get(i) -> Column:
        return F.col("t")[i] if named else cell(F.col("t"), i)

    names = ("open", "high", "low", "close", "volume")
    # one venue compares in milliseconds, which the floor restores
    df = (df.withColumn("ts_ns", whole(get(at[0])) * unit)
          .withColumn("_start", floor_ns("start_ns", MS) if venue == "okx" else F.col("start_ns"))
          .withColumn("_end", F.col("end_ns")))
    count = F.lit(0) if at[6] is None else F.coalesce(whole(get(at[6])), F.lit(0)).cast("int")
    return _window(df, ends).select(
        "ts_ns", "symbol", F.lit(venue).alias("venue"),
        *[num(get(at[i + 1])).alias(n) for i, n in enumerate(names)], count.alias("trades")).dropna(
        subset=["ts_ns", "open", "high", "low", "close"])
