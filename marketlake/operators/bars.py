"""One-second bars per venue, and the older blend of per-venue bars."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.timeutil import second_of
from marketlake.sources.venues import venue_bit

# MAD to sigma factor and the guards used when the spread is degenerate.
MAD_TO_SIGMA = 1.4826
RELATIVE_GUARD = 1e-3
ABSOLUTE_GUARD = 1e-12


def within_robust_band(price: Column, med: Column, mad: Column, k: float, n: Column, min_n: int) -> Column:
    """Keep test of the median/MAD filter; everything passes below ``min_n`` contributors."""
    dev = F.abs(price - med)
    relative = F.greatest(med * F.lit(RELATIVE_GUARD), F.lit(ABSOLUTE_GUARD))
    return ((n < min_n)
            | ((mad <= 0) & (dev <= relative))
            | ((mad > 0) & (dev <= F.lit(float(k)) * (mad * F.lit(MAD_TO_SIGMA)))))


def vwap_or(fallback: Column, notional: Column, volume: Column) -> Column:
    return F.when(volume > 0, notional / volume).otherwise(fallback)


def bars_from_trades(trades: DataFrame, arrival: Sequence[str] = ("seq",), keys: Sequence[str] = (),
                     second: Column | None = None) -> DataFrame:
    """Per (second, symbol, venue) OHLCV. Fixed-size partial aggregates, one shuffle; the
    second leads the key so that sorts inside the aggregate compare longs first.

    ``arrival`` breaks ties on ``ts_ns``; the receive time deliberately does not.
    Works on a stream when ``keys``/``second`` carry the event-time window.
    """
    order = F.struct("ts_ns", *arrival)
    sec = second if second is not None else second_of("ts_ns")
    agg = (trades.groupBy(*keys, sec.alias("sec_ns"), "symbol", "venue")
           .agg(F.min_by("price", order).alias("open"),
                F.max("price").alias("high"),
                F.min("price").alias("low"),
                F.max_by("price", order).alias("close"),
                F.sum("size").alias("volume"),
                F.sum(F.col("price") * F.col("size")).alias("_notional"),
                F.count(F.lit(1)).cast("int").alias("trades"),
                F.max("ingested_at_ns").alias("ingested_at_ns")))
    return agg.select(F.col("sec_ns").alias("ts_ns"), "symbol", "venue", "open", "high", "low", "close",
                      "volume",
                      vwap_or(F.col("close"), F.col("_notional"), F.col("volume")).alias("vwap"),
                      "trades", F.lit(0).alias("sources_mask"), "ingested_at_ns")


def blend_bars(bars: DataFrame, outlier_sigma: float = 5.0, excluded_venues: Iterable[str] = (),
               bits: dict[str, int] | None = None) -> DataFrame:
    """Volume-weighted blend of the per-venue bars of a second, outlier closes removed.

    A (symbol, second) group holds one bar per venue, so the windows stay tiny.
    """
    live = bars.where(F.col("volume") > 0)
    if excluded_venues:
        live = live.where(~F.col("venue").isin(list(excluded_venues)))
    w = Window.partitionBy("ts_ns", "symbol")
    kept = (live.withColumn("_n", F.count(F.lit(1)).over(w))
            .withColumn("_med", F.median("close").over(w))
            .withColumn("_dev", F.abs(F.col("close") - F.col("_med")))
            .withColumn("_mad", F.median("_dev").over(w))
            .where(within_robust_band(F.col("close"), F.col("_med"), F.col("_mad"), outlier_sigma,
                                      F.col("_n"), 3)))

    def weighted(c: str) -> Column:
        return F.sum(F.col(c) * F.col("volume")) / F.sum("volume")

    out = (kept.groupBy("ts_ns", "symbol")
           .agg(weighted("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"),
                weighted("close").alias("close"), F.sum("volume").alias("_v"),
                weighted("vwap").alias("vwap"), F.sum("trades").cast("int").alias("trades"),
                F.bit_or(venue_bit(F.col("venue"), bits)).alias("sources_mask"),
                F.max("ingested_at_ns").alias("ingested_at_ns")))
    return out.select("ts_ns", "symbol", F.lit("agg").alias("venue"), "open", "high", "low", "close",
                      F.col("_v").alias("volume"), "vwap", "trades", "sources_mask", "ingested_at_ns")
