"""The consolidated tape: one bar per (symbol, second) over all spot venues.

The outlier filter looks at prices only, so trades are first merged into price
levels (symbol, second, price, venue). That merge runs map-side and spreads a hot
second over its price levels; everything the tape needs survives it: counts,
volume, first and last print. Only levels meet in one place per second, and their
number is bounded by the price grid, not by the number of trades.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.ordered import as_of, weighted_medians
from marketlake.functions.timeutil import MS, SECOND, second_of
from marketlake.operators.bars import within_robust_band
from marketlake.schemas import BAR_COLUMNS
from marketlake.session import shared_dir
from marketlake.sources.store import materialize
from marketlake.sources.venues import SPOT_VENUES, venue_bit

# Tape parameters.
MAD_K = 5.0
MIN_VENUES = 3
STALE_RECV_LAG_MS = 5000

DIAGNOSTICS = ["ts_ns", "symbol", "n_raw", "n_kept", "n_dropped", "median_px", "venues"]


def spot_only(trades: DataFrame) -> DataFrame:
    return trades.where(F.col("venue").isin(list(SPOT_VENUES)))


def gate_trades(trades: DataFrame, excluded_venues: Iterable[str] = (),
                stale_recv_lag_ms: float | None = STALE_RECV_LAG_MS) -> DataFrame:
    """Drop excluded venues, prints received too late, and empty prints."""
    excluded = list(excluded_venues)
    out = trades.where(F.col("size") > 0)
    if excluded:
        out = out.where(~F.col("venue").isin(excluded))
    if stale_recv_lag_ms:
        lag = F.coalesce(F.col("recv_ns"), F.col("ts_ns")) - F.col("ts_ns")
        out = out.where(lag <= int(stale_recv_lag_ms * MS))
    return out


def merge_trades(trades: DataFrame, arrival: Sequence[str] = ("seq",)) -> DataFrame:
    """All venues in one total order. The sort key includes the arrival columns, so the
    range partitioning can cut any symbol or instant."""
    return trades.orderBy("symbol", "ts_ns", "recv_ns", "venue", *arrival)


def price_levels(trades: DataFrame, arrival: Sequence[str] = ("seq",), keys: Sequence[str] = (),
                 second: Column | None = None) -> DataFrame:
    """Merge gated trades into (second, symbol, price, venue) levels. Batch and stream.

    The second leads the key: sorts inside the aggregate then compare longs first.
    """
    order = F.struct("ts_ns", "recv_ns", *arrival)
    sec = second if second is not None else second_of("ts_ns")
    return (trades.groupBy(*keys, sec.alias("sec_ns"), "symbol", "price", "venue")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("volume"),
                 F.min(order).alias("first_print"), F.max(order).alias("last_print"),
                 F.max("ingested_at_ns").alias("ingested_at_ns")))


def mark_levels(levels: DataFrame, mad_k: float = MAD_K, min_venues: int = MIN_VENUES,
                hot_levels: int | None = None) -> DataFrame:
    """Add the trade-weighted median of the second and whether the level survives.

    With ``hot_levels``, seconds of more levels than that are handled apart (``mark_hot_levels``): venues without a
    price grid can fill one second with any number of levels. Levels are then counted first, in batch only.
    """
    if hot_levels is not None:
        key = ["sec_ns", "symbol"]
        levels = materialize(levels, shared_dir(levels.sparkSession, "levels"))
        hot = levels.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_levels).select(*key)
        rest = mark_levels(levels.join(hot, key, "left_anti"), mad_k, min_venues)
        return rest.unionByName(mark_hot_levels(levels.join(hot, key, "left_semi"), mad_k, min_venues))
    w = Window.partitionBy("sec_ns", "symbol")
    return (levels
            .withColumn("n_venues", F.size(F.collect_set("venue").over(w)))
            .withColumn("median_px", F.percentile("price", F.lit(0.5), F.col("n")).over(w))
            .withColumn("dev", F.abs(F.col("price") - F.col("median_px")))
            .withColumn("mad", F.percentile("dev", F.lit(0.5), F.col("n")).over(w))
            .withColumn("kept", within_robust_band(F.col("price"), F.col("median_px"), F.col("mad"), mad_k,
                                                   F.col("n_venues"), min_venues)))


def mark_hot_levels(levels: DataFrame, mad_k: float = MAD_K, min_venues: int = MIN_VENUES) -> DataFrame:
    """The same marks where the levels of one second are too many for one task: medians by weights along sorted
    levels, and one row per second joined back. The levels are stored, as they are read several times."""
    key = ["sec_ns", "symbol"]

    def store(rows: DataFrame) -> DataFrame:
        return materialize(rows, shared_dir(levels.sparkSession, "hot-levels"))

    levels = store(levels)
    seconds = (levels.groupBy(*key).agg(F.count_distinct("venue").cast("int").alias("n_venues"))
               .join(weighted_medians(levels, key, "price", "n", store).withColumnRenamed("median", "median_px"), key))
    far = levels.join(seconds, key).withColumn("dev", F.abs(F.col("price") - F.col("median_px")))
    mads = weighted_medians(far, key, "dev", "n", store).withColumnRenamed("median", "mad")
    return (far.join(mads, key).select(*levels.columns, "n_venues", "median_px", "dev", "mad")
            .withColumn("kept", within_robust_band(F.col("price"), F.col("median_px"), F.col("mad"), mad_k,
                                                   F.col("n_venues"), min_venues)))


def roll_levels(marked: DataFrame, bits: dict[str, int] | None = None) -> DataFrame:
    """One row per (symbol, second): the bar of the survivors plus the diagnostics.
    Bar columns are null where nothing survived."""
    kept = F.col("kept")

    def if_kept(c) -> Column:
        return F.when(kept, c if isinstance(c, Column) else F.col(c))

    def edge(prints: str) -> Column:
        # the venue ranks between the receive time and the arrival order
        return if_kept(F.struct(f"{prints}.ts_ns", f"{prints}.recv_ns", "venue", prints, "price"))

    rolled = (marked.groupBy("sec_ns", "symbol")
              .agg(F.min(edge("first_print")).alias("_first"), F.max(edge("last_print")).alias("_last"),
                   F.max(if_kept("price")).alias("high"), F.min(if_kept("price")).alias("low"),
                   F.sum(if_kept("volume")).alias("volume"),
                   F.sum(if_kept(F.col("price") * F.col("volume"))).alias("_notional"),
                   F.bit_or(if_kept(venue_bit(F.col("venue"), bits))).alias("sources_mask"),
                   F.coalesce(F.sum(if_kept("n")), F.lit(0)).alias("n_kept"),
                   F.sum("n").alias("n_raw"), F.first("median_px").alias("median_px"),
                   F.array_sort(F.collect_set(if_kept("venue"))).alias("_kept_venues"),
                   F.array_sort(F.collect_set("venue")).alias("_raw_venues"),
                   F.max("ingested_at_ns").alias("ingested_at_ns")))
    return rolled.select(
        F.col("sec_ns").alias("ts_ns"), "symbol", F.lit("agg").alias("venue"),
        F.col("_first.price").alias("open"), "high", "low", F.col("_last.price").alias("close"), "volume",
        (F.col("_notional") / F.col("volume")).alias("vwap"), F.col("n_kept").cast("int").alias("trades"),
        "sources_mask", "ingested_at_ns", "n_raw", "n_kept",
        (F.col("n_raw") - F.col("n_kept")).alias("n_dropped"), "median_px",
        F.when(F.col("n_kept") > 0, F.col("_kept_venues")).otherwise(F.col("_raw_venues")).alias("venues"))


def tape_with_diagnostics(trades: DataFrame, *, mad_k: float = MAD_K, min_venues: int = MIN_VENUES,
                          excluded_venues: Iterable[str] = (),
                          stale_recv_lag_ms: float | None = STALE_RECV_LAG_MS,
                          bits: dict[str, int] | None = None,
                          arrival: Sequence[str] = ("seq",), hot_levels: int | None = None) -> DataFrame:
    gated = gate_trades(trades, excluded_venues, stale_recv_lag_ms)
    return roll_levels(mark_levels(price_levels(gated, arrival), mad_k, min_venues, hot_levels), bits)


def build_tape(trades: DataFrame, **options) -> DataFrame:
    """Tape bars in the stored bar layout; seconds without a survivor have no bar."""
    return tape_with_diagnostics(trades, **options).where(F.col("n_kept") > 0).select(*BAR_COLUMNS)


def filter_diagnostics(trades: DataFrame, **options) -> DataFrame:
    return tape_with_diagnostics(trades, **options).select(*DIAGNOSTICS)


def run_summary(diagnostics: DataFrame, feeds: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Per key: contributing venues, bars built, trades dropped and consolidated.

    ``feeds`` carries the keys, ``venue`` and ``trades`` (a count); per-venue bars qualify,
    so a build need not read its trades again.
    """
    built = diagnostics.groupBy(*keys).agg(
        F.count_if(F.col("n_kept") > 0).alias("agg_bars"),
        F.sum("n_dropped").alias("trades_dropped_by_filter"))
    seen = feeds.groupBy(*keys).agg(
        F.sum("trades").alias("consolidated_trades"),
        F.array_sort(F.collect_set("venue")).alias("contributing_venues"))
    return seen.join(built, list(keys), "left")


def exclude_down(trades: DataFrame, status: DataFrame, cell_ns: int = 300 * SECOND) -> DataFrame:
    """Drop trades made while their feed's latest status was DOWN. Feeds without a status are taken as up.

    Trades meet the status rows of their own cell of time and the one status that the cell starts with.
    """
    feed = status.where(F.col("stream") == "trades").select("venue", "symbol", F.col("ts_ns").alias("_since"),
                                                            F.col("up").alias("_up"))
    judged = as_of(trades, feed, ["venue", "symbol"], "ts_ns", "_since", ["_up"], cell_ns)
    return judged.where(F.coalesce("_up", F.lit(True))).drop("_up")
