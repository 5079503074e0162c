"""Funding and open interest messages of the derivatives venues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.sources.frames.common import (LIST, OBJECT, cell, ms_ns, msg, num, of_venue, present, recv_ms_ns,
                                              rows_as)
from marketlake.sources.frames.trades import field, unwrapped
from marketlake.sources.venues import canonical_of


def binance_futures_funding(frames: DataFrame) -> DataFrame:
    df = unwrapped(frames, "binance_futures").where(field("e", "d") == "markPriceUpdate")
    return rows_as(df, "funding", "binance_futures", ("funding_rate", "mark_price"), ts_ns=ms_ns(field("E", "d")),
                   symbol=canonical_of(field("s", "d"), "binance_futures"), funding_rate=num(field("r", "d")),
                   mark_price=num(field("p", "d")), next_ts_ns=F.nullif(ms_ns(field("T", "d")), F.lit(0)))


def bybit_funding(frames: DataFrame) -> DataFrame:
    """Only ticker messages that carry a rate; partial updates without one are skipped."""
    topic = F.startswith(msg("topic"), F.lit("tickers."))
    df = of_venue(frames, "bybit", topic="string", ts="string", data=OBJECT).where(topic).withColumn(
        "d", msg("data"))
    return rows_as(df, "funding", "bybit", ("funding_rate",), ts_ns=F.coalesce(ms_ns(msg("ts")), recv_ms_ns()),
                   symbol=canonical_of(field("symbol", "d"), "bybit"), funding_rate=num(field("fundingRate", "d")),
                   mark_price=num(present(field("markPrice", "d"))),
                   next_ts_ns=F.nullif(ms_ns(present(field("nextFundingTime", "d"))), F.lit(0)))


def binance_futures_oi(frames: DataFrame) -> DataFrame:
    df = of_venue(frames, "binance_futures", symbol="string", openInterest="string", time="string").where(msg("openInterest").isNotNull())
    return rows_as(df, "open_interest", "binance_futures", ("oi_base",), ts_ns=ms_ns(msg("time")),
                   symbol=canonical_of(msg("symbol"), "binance_futures"), oi_base=num(msg("openInterest")))


def bybit_oi(frames: DataFrame) -> DataFrame:
    """Only the newest reading of each page."""
    df = of_venue(frames, "bybit", result=f"struct<symbol:string,list:{LIST}>").withColumn("d", msg("result"))
    df = df.withColumn("t", cell(field("list", "d"), 0))
    return rows_as(df, "open_interest", "bybit", ("oi_base",), ts_ns=ms_ns(field("timestamp")),
                   symbol=canonical_of(field("symbol", "d"), "bybit"), oi_base=num(field("openInterest")))


FUNDING = {"binance_futures": binance_futures_funding, "bybit": bybit_funding}
OPEN_INTEREST = {"binance_futures": binance_futures_oi, "bybit": bybit_oi}
