"""Tape against venues: tracking error, dispersion, provenance and filter anatomy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.ordered import exact_percentiles
from marketlake.operators.quality import second_extremes
from marketlake.sources.venues import known_venue, mask_bits, present_venues


def wide_closes(bars: DataFrame, venues: Sequence[str] | None = None) -> DataFrame:
    """One close column per venue and second: a full outer alignment done as one grouping.

    Without ``venues`` those present; with them any other venue stops the query.
    """
    columns = present_venues(bars) if venues is None else list(venues)
    return (bars.withColumn("venue", known_venue(venues)).groupBy("ts_ns", "symbol").pivot("venue", columns)
            .agg(F.max("close")))


def tracking_error(bars: DataFrame) -> DataFrame:
    """Each venue's close against the tape close of the same second, in bps."""
    # one shuffle puts the tape next to the few venue bars of its second
    second = Window.partitionBy("ts_ns", "symbol")
    tape_close = F.max(F.when(F.col("venue") == "agg", F.col("close"))).over(second)
    return (bars.select("ts_ns", "symbol", "venue", "close").withColumn("tape_close", tape_close)
            .where((F.col("venue") != "agg") & F.col("tape_close").isNotNull())
            .withColumn("te_bps", (F.col("close") - F.col("tape_close")) / F.col("tape_close") * 1e4))


def describe(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """count, mean, std, min, quartiles and max per key; quartiles are exact, and a long series never meets in one buffer."""
    v = F.col(value)
    moments = df.where(v.isNotNull()).groupBy(*keys).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"),
        F.max(v).alias("max"))
    quartiles = exact_percentiles(df, keys, value, {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles, list(keys))


def dispersion(bars: DataFrame) -> DataFrame:
    """Spread of venue closes per second, in bps of their mid."""
    mid = F.nullif((F.col("lo") + F.col("hi")) / 2, F.lit(0.0))
    return (second_extremes(bars.where(F.col("venue") != "agg"))
            .select("ts_ns", "symbol", ((F.col("hi") - F.col("lo")) / mid * 1e4).alias("disp_bps")))


def mask_presence(tape: DataFrame) -> DataFrame:
    """Per symbol and venue: share of tape seconds the venue contributed to, in percent."""
    bits = mask_bits()
    flags = tape.groupBy("symbol").agg(*[
        (F.avg((F.col("sources_mask").bitwiseAND(F.lit(b)) != 0).cast("int")) * 100).alias(v)
        for v, b in bits.items()])
    return flags.unpivot(["symbol"], list(bits), "venue", "share_pct").where(F.col("share_pct") > 0)


def mask_histogram(tape: DataFrame) -> DataFrame:
    return (tape.groupBy("symbol", F.bit_count("sources_mask").alias("n_venues"))
            .agg(F.count(F.lit(1)).alias("seconds")))


def filter_anatomy(diagnostics: DataFrame) -> DataFrame:
    """Per symbol: trades seen, dropped, their share, and seconds where the filter fired."""
    return diagnostics.groupBy("symbol").agg(
        F.sum("n_raw").alias("n_raw"), F.sum("n_dropped").alias("n_dropped"),
        (F.sum("n_dropped") * 100.0 / F.greatest(F.sum("n_raw"), F.lit(1))).alias("dropped_pct"),
        F.count_if(F.col("n_dropped") > 0).alias("fired_seconds"))


def tape_breaches(tape: DataFrame, venue_bars: DataFrame, slack: float = 1e-6) -> DataFrame:
    """Per symbol: seconds compared, and tape closes outside the venues' last prints."""
    edge = venue_bars.groupBy("ts_ns", "symbol").agg(F.min("close").alias("lo"), F.max("close").alias("hi"))
    both = tape.select("ts_ns", "symbol", "close").join(edge, ["ts_ns", "symbol"])
    out = (F.col("close") < F.col("lo") - slack) | (F.col("close") > F.col("hi") + slack)
    return both.groupBy("symbol").agg(F.count(F.lit(1)).alias("seconds"), F.count_if(out).alias("breaches"))
