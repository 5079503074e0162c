"""Registered streaming queries: drain the available input, then read the sink back."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timeutil import second_of
from marketlake.operators import health as H
from market_fixtures import frame_views as V
from marketlake.plans.catalogue import bars_out, query, r
from marketlake.plans.frame_queries import _out, ladder_text
from marketlake.plans.market_views import MarketViews
from marketlake.session import shared_dir
from marketlake.sources.frames.level2 import LEVEL_EVENTS, stream_books
from marketlake.sources.store import Lake
from marketlake.streaming import jobs as J


def live(v: MarketViews) -> MarketViews:
    """The same views over a stream of the events table. The braces make the path a pattern,
    which the file source accepts for one file as well as for a folder of files."""
    stream = v.spark.readStream.schema(v.events.schema).parquet(f"{v.sf_dir}/{{events.parquet}}")
    return MarketViews(v.spark, v.sf_dir, stream)


def into_lake(v: MarketViews, start: Callable[[Lake, str], object]) -> Lake:
    base = shared_dir(v.spark, "stream-lake")
    lake = Lake(v.spark, f"{base}/lake")
    start(lake, f"{base}/checkpoint").awaitTermination()
    return lake


@query("stream_bars_1s")
def _bars(v, n):
    return bars_out(into_lake(v, lambda lake, cp: J.write_bars(
        J.bars_stream(live(v).trades), lake, cp, available_now=True)).table("bars_1s"))


@query("stream_tape_1s")
def _tape(v, n):
    return bars_out(into_lake(v, lambda lake, cp: J.write_tape(
        J.levels_stream(live(v).trades), lake, cp, available_now=True)).table("bars_1s"))


@query("stream_sink")
def _sink(v, n):
    return into_lake(v, lambda lake, cp: J.write_raw(live(v).trades, "trades", lake, cp, available_now=True)).table("trades")


@query("stream_then_append")
def _then_append(v, n):
    """Streamed trades, late ones appended in batch, all rebuilt: bars of the one table."""
    late = F.col("seq") % 11 == 5
    lake = into_lake(v, lambda lake, cp: J.write_raw(live(v).trades.where(~late), "trades", lake, cp, available_now=True))
    lake.append("trades", v.trades.where(late))
    per_second = lake.table("trades").groupBy(second_of("ts_ns").alias("ts_ns"), "symbol", "venue")
    return r(per_second.agg(F.count(F.lit(1)).alias("trades"), F.max("price").alias("high"), F.min("price").alias("low"),
                            F.sum("size").alias("volume")), "high low volume")


@query("stream_health")
def _health(v, n):
    feeds = live(v).trades.select("venue", "symbol", F.lit("trades").alias("stream"), "recv_ns")
    lake = into_lake(v, lambda lake, cp: J.write_health(J.counts_stream(feeds), lake, cp, available_now=True))
    status = lake.meta("venue_status").withColumn("recent_per_s", F.col("coverage_pct"))
    return r(status.select("ts_ns", *H.FEED, "up", "recent_per_s"), "recent_per_s", 8)


@query("stream_book")
def _book(v, n):
    events = LEVEL_EVENTS["coinbase"](V.level2_frames(live(v).trades, "coinbase"))
    lake = into_lake(v, lambda lake, cp: J.write_books(stream_books(events, "coinbase", depth=5), lake, cp, available_now=True))
    return ladder_text(_out(lake.table("book_l2_snapshot").drop("date")))


@query("stream_bbo")
def _bbo(v, n):
    frames = V.quote_frames(live(v).quotes, "gemini")
    lake = into_lake(v, lambda lake, cp: J.write_quotes(J.best_quotes_stream(frames), lake, cp, available_now=True))
    return r(_out(lake.table("quotes").drop("date")), "bid_px ask_px")
