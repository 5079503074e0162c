"""Feed health and the list of gaps worth fetching again."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.timeutil import DAY, MINUTE, SECOND, date_text, floor_ns

# Health parameters.
RECENT_S = 300
BASELINE_S = 3600
DOWN_RATIO = 0.10

FEED = ("venue", "symbol", "stream")


def judged(df: DataFrame, ratio: float = DOWN_RATIO, silent_is_down: bool = False) -> DataFrame:
    """Rates with ``up``: a recent rate of at least ``ratio`` of the baseline, or no baseline."""
    silent = F.col("baseline_per_s") == 0
    alive = F.col("recent_per_s") >= F.col("baseline_per_s") * ratio
    return df.withColumn("up", ~silent & alive if silent_is_down else silent | alive)


def feed_health(rows: DataFrame, now_ns: int, recent_s: int = RECENT_S, baseline_s: int = BASELINE_S,
                ratio: float = DOWN_RATIO, silent_is_down: bool = False, feeds: DataFrame | None = None) -> DataFrame:
    """Message rates of each feed at one instant. ``rows`` carry venue, symbol, stream, recv_ns.

    ``feeds (venue, symbol, stream)`` lists the feeds to judge: only the baseline window is then read, by date where
    the rows have one, and a feed silent in it keeps rate 0. Without the list, feeds are those ever seen.
    """
    start = now_ns - baseline_s * SECOND
    seen = rows.where(F.col("recv_ns") <= now_ns)
    if feeds is not None:
        seen = seen.where(F.col("recv_ns") >= start)
        if "date" in rows.columns:  # events carry the date of ts_ns; a message is received within a day of it
            seen = seen.where(F.col("date").cast("string").between(date_text(start - DAY), date_text(now_ns + DAY)))

    def rate(window_s: int):
        return F.count_if(F.col("recv_ns") >= now_ns - window_s * SECOND) / F.lit(float(window_s))

    rates = seen.groupBy(*FEED).agg(rate(recent_s).alias("recent_per_s"), rate(baseline_s).alias("baseline_per_s"))
    if feeds is not None:
        rates = feeds.select(*FEED).distinct().join(rates, list(FEED), "left").fillna(0.0, ["recent_per_s", "baseline_per_s"])
    return judged(rates, ratio, silent_is_down)


def per_step_counts(rows: DataFrame, step_ns: int = MINUTE) -> DataFrame:
    """Messages per feed and step, labelled by the end of the step. Merges map-side."""
    return (rows.groupBy((floor_ns("recv_ns", step_ns) + F.lit(step_ns)).alias("ts_ns"), *FEED)
            .agg(F.count(F.lit(1)).alias("n")))


def health_series(counts: DataFrame, recent_s: int = RECENT_S, baseline_s: int = BASELINE_S,
                  ratio: float = DOWN_RATIO, silent_is_down: bool = False) -> DataFrame:
    """Health at the end of every step that saw a message, from per-step counts: the
    trailing windows run over one row per step instead of over every message."""
    w = Window.partitionBy(*FEED).orderBy("ts_ns")

    def rate(window_s: int):
        frame = w.rangeBetween(-(window_s * SECOND) + 1, 0)
        return F.sum("n").over(frame) / F.lit(float(window_s))

    rates = counts.withColumns({"recent_per_s": rate(recent_s), "baseline_per_s": rate(baseline_s)})
    return judged(rates, ratio, silent_is_down)


def status_rows(health: DataFrame, ts_ns=None) -> DataFrame:
    """venue_status layout; ``coverage_pct`` holds the recent rate, as stored rows always did."""
    ts = F.col("ts_ns") if ts_ns is None else F.lit(ts_ns)
    return health.select(ts.cast("long").alias("ts_ns"), *FEED, "up", F.col("recent_per_s").alias("coverage_pct"),
                         F.lit(None).cast("string").alias("notes"), "recent_per_s", "baseline_per_s")


def latest_status(status: DataFrame) -> DataFrame:
    """Rows of the newest snapshot, through a one-row scalar subquery."""
    newest = status.select(F.max("ts_ns")).scalar()
    return (status.where(F.col("ts_ns") == newest)
            .select("venue", "stream", "symbol", "up", "ts_ns").orderBy("venue", "stream", "symbol"))


def gap_worklist(trades: DataFrame, listed: DataFrame, now_ns: int, lookback_minutes: int = 120,
                 min_gap_s: int = 60) -> DataFrame:
    """Listed feeds silent for at least ``min_gap_s`` and the range to fetch for each."""
    start = now_ns - lookback_minutes * MINUTE
    recent = trades.where((F.col("ts_ns") >= start) & (F.col("ts_ns") <= now_ns))
    if "date" in trades.columns:
        recent = recent.where(F.col("date").cast("string").between(date_text(start), date_text(now_ns)))
    last = recent.groupBy("venue", "symbol").agg(F.max("ts_ns").alias("last_seen"))
    return (listed.select("venue", "symbol").distinct().join(last, ["venue", "symbol"], "left")
            .withColumn("last_seen", F.coalesce("last_seen", F.lit(start)))
            .where(F.lit(now_ns) - F.col("last_seen") >= min_gap_s * SECOND)
            .select("venue", "symbol", (F.col("last_seen") + 1).alias("fetch_from_ns"),
                    F.lit(now_ns).alias("fetch_to_ns")))
