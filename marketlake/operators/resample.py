"""Higher timeframes from one-second bars: left-closed, left-labelled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timeutil import DAY, SECOND, floor_ns, parse_timeframe
from marketlake.operators.bars import vwap_or

SERIES = ("symbol", "venue")


def resample_bars(bars: DataFrame, timeframe: str, keys: Sequence[str] = SERIES,
                  mask: str = "max") -> DataFrame:
    """Empty windows produce no row. ``mask='or'`` unions venue bits instead of taking
    the largest mask seen."""
    frame = parse_timeframe(timeframe)
    if frame.step == SECOND and timeframe.strip().lower() == "1s":
        return bars
    origin: Column | int = frame.origin
    if frame.anchored:
        # one anchor row per series; the grid starts at midnight of its first day
        anchors = bars.groupBy(*keys).agg(floor_ns(F.min("ts_ns"), DAY).alias("_anchor"))
        bars, origin = bars.join(anchors, list(keys)), F.col("_anchor")
    merge_mask = F.bit_or if mask == "or" else F.max
    out = (bars.groupBy(*keys, floor_ns("ts_ns", frame.step, origin).alias("bucket_ns"))
           .agg(F.min_by("open", "ts_ns").alias("open"), F.max("high").alias("high"),
                F.min("low").alias("low"), F.max_by("close", "ts_ns").alias("close"),
                F.sum("volume").alias("volume"),
                F.sum(F.col("vwap") * F.col("volume")).alias("_pxv"),
                F.sum("trades").alias("trades"),
                merge_mask("sources_mask").alias("sources_mask"),
                F.max("ingested_at_ns").alias("ingested_at_ns")))
    return out.select(F.col("bucket_ns").alias("ts_ns"), *keys, "open", "high", "low", "close", "volume",
                      vwap_or(F.col("close"), F.col("_pxv"), F.col("volume")).alias("vwap"),
                      "trades", F.coalesce("sources_mask", F.lit(0)).alias("sources_mask"),
                      "ingested_at_ns")
