"""Order-book snapshots: top of book and level invariants, all in array functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _both_sides() -> Column:
    return (F.size("bids") > 0) & (F.size("asks") > 0)


def book_top(books: DataFrame) -> DataFrame:
    """Best bid/ask, mid, spread in bps of mid and top imbalance; one-sided books are skipped."""
    bid, ask = F.get("bids", F.lit(0)), F.get("asks", F.lit(0))
    top = books.where(_both_sides()).select(
        "ts_ns", "symbol", "venue", bid["px"].alias("bid_px"), bid["sz"].alias("bid_sz"),
        ask["px"].alias("ask_px"), ask["sz"].alias("ask_sz"))
    mid = (F.col("bid_px") + F.col("ask_px")) / 2
    depth = F.col("bid_sz") + F.col("ask_sz")
    return (top.withColumn("mid", mid)
            .withColumn("spread_bps", F.when(F.col("mid") > 0, (F.col("ask_px") - F.col("bid_px"))
                                             / F.col("mid") * 1e4))
            .withColumn("imbalance", F.when(depth > 0, (F.col("bid_sz") - F.col("ask_sz")) / depth)))


def _breaks_order(px: Column, ascending: bool) -> Column:
    """Whether any adjacent pair of the price array is out of order."""
    pairs = F.zip_with(F.slice(px, 1, F.greatest(F.size(px) - 1, F.lit(0))),
                       F.slice(px, 2, F.greatest(F.size(px) - 1, F.lit(0))),
                       (lambda a, b: a > b) if ascending else (lambda a, b: a < b))
    return F.exists(pairs, lambda bad: bad)


# Issue names.
BOOK_ISSUES = ("empty_side", "crossed_top", "bids_not_descending", "asks_not_ascending",
               "nonpositive_level", "duplicate_price_level")


def book_quality(books: DataFrame, keys=("symbol", "venue")) -> DataFrame:
    """Per series: snapshots seen, count per broken invariant, and the clean percentage,
    which goes below zero when snapshots break several invariants."""
    bpx, apx = F.col("bids.px"), F.col("asks.px")
    bad_level = (F.exists("bids", lambda x: (x["px"] <= 0) | (x["sz"] < 0))
                 | F.exists("asks", lambda x: (x["px"] <= 0) | (x["sz"] < 0)))
    repeated = ((F.size(F.array_distinct(bpx)) != F.size(bpx))
                | (F.size(F.array_distinct(apx)) != F.size(apx)))
    tests = {"crossed_top": F.get(bpx, F.lit(0)) >= F.get(apx, F.lit(0)),
             "bids_not_descending": _breaks_order(bpx, ascending=False),
             "asks_not_ascending": _breaks_order(apx, ascending=True),
             "nonpositive_level": bad_level, "duplicate_price_level": repeated}
    full = _both_sides()
    counted = books.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_snapshots"),
        F.count_if(~F.coalesce(full, F.lit(False))).alias("empty_side"),
        *[F.count_if(full & t).alias(n) for n, t in tests.items()])
    broken = sum((F.col(n) for n in BOOK_ISSUES[1:]), F.col(BOOK_ISSUES[0]))
    return counted.withColumn("clean_pct", F.round((1 - broken / F.col("n_snapshots")) * 100, 2))


def book_issues(books: DataFrame, keys=("symbol", "venue")) -> DataFrame:
    """Long form of ``book_quality``: one row per broken invariant, zero counts omitted."""
    return (book_quality(books, keys)
            .unpivot([*keys, "n_snapshots", "clean_pct"], list(BOOK_ISSUES), "issue", "count")
            .where(F.col("count") > 0))
