"""Registered queries over rendered venue messages."""

from __future__ import annotations

from pyspark.sql import DataFrame

from market_fixtures import frame_views as V
from marketlake.functions.timeutil import second_of
from marketlake.operators.bars import bars_from_trades
from marketlake.plans.catalogue import bars_out, query, r
from marketlake.session import shared_dir
from marketlake.sources.frames import PARSERS, normalise
from marketlake.sources.frames.level2 import LEVEL_EVENTS, rebuild_books
from marketlake.sources.frames.pages import KLINE_PAGES, TRADE_PAGES, rest_funding, rest_klines, rest_trades
from marketlake.sources.store import ARRIVAL, Lake, materialize


def _out(df: DataFrame) -> DataFrame:
    return df.drop("ingested_at_ns", "arrival")


def _venue(name: str, stream: str) -> str:
    return name.removeprefix("norm_").removesuffix("_" + stream)


@query(*[f"norm_{v}_trades" for v in PARSERS["trades"]])
def _trades(v, n):
    venue = _venue(n, "trades")
    return _out(normalise(V.trade_frames(v.trades, venue), venue, "trades"))


@query("bars_from_frames")
def _bars_from_frames(v, n):
    """Messages of two venues with ties on the event time, parsed and stored: receive time, connection and sequence decide."""
    tied = v.trades.withColumn("ts_ns", second_of("ts_ns"))
    lake = Lake(v.spark, shared_dir(v.spark, "frames-lake"))
    for venue in ("coinbase", "kraken"):
        lake.append("trades", normalise(V.trade_frames(tied.where(tied.venue == venue), venue), venue, "trades"))
    return bars_out(bars_from_trades(lake.arrivals("trades"), ARRIVAL)).drop("ingested_at_ns")


@query(*[f"norm_{v}_quotes" for v in PARSERS["quotes"]])
def _quotes(v, n):
    venue = _venue(n, "quotes")
    return r(_out(normalise(V.quote_frames(v.quotes, venue), venue, "quotes")), "bid_px ask_px")


@query("norm_bybit_funding", "norm_binance_futures_funding")
def _funding(v, n):
    venue = _venue(n, "funding")
    return _out(normalise(V.funding_frames(v.trades, venue), venue, "funding"))


@query("norm_bybit_oi", "norm_binance_futures_oi")
def _oi(v, n):
    venue = _venue(n, "oi")
    return _out(normalise(V.oi_frames(v.trades, venue), venue, "open_interest"))


@query("norm_binance_book")
def _book(v, n):
    from pyspark.sql import functions as F
    b = normalise(V.depth_frames(v.books), "binance", "book_l2_snapshot", depth=6)
    side = "array_join(transform({s}, x -> concat(string(round(x.px, 4)), '@', string(x.sz))), ' ')"
    return _out(b.withColumns({s: F.expr(side.format(s=s)) for s in ("bids", "asks")}))


@query(*[f"rest_{v}_trades" for v in TRADE_PAGES])
def _rest_trades(v, n):
    venue = n.removeprefix("rest_").removesuffix("_trades")
    return _out(rest_trades(V.trade_pages(v.trades, venue), venue))


@query("rest_bybit_funding", "rest_binance_futures_funding")
def _rest_funding(v, n):
    venue = n.removeprefix("rest_").removesuffix("_funding")
    return _out(rest_funding(V.funding_pages(v.trades, venue), venue))


@query(*[f"norm_{v}_klines" for v in KLINE_PAGES])
def _klines(v, n):
    venue = _venue(n, "klines")
    return rest_klines(V.kline_pages(v.venue_bars, venue), venue)


def ladder_text(df: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F
    side = "array_join(transform({s}, x -> concat(string(x.px), '@', string(x.sz))), ' ')"
    return df.withColumns({s: F.expr(side.format(s=s)) for s in ("bids", "asks")})


@query("norm_coinbase_book", "norm_kraken_book")
def _books(v, n):
    venue = _venue(n, "book")
    # decoded once, then read by each step of the rebuild
    events = materialize(LEVEL_EVENTS[venue](V.level2_frames(v.trades, venue)), shared_dir(v.spark, "levels"))
    # short blocks, so that the hand-over between blocks is exercised at any size
    return ladder_text(_out(rebuild_books(events, venue, depth=5, block_events=1024)))
