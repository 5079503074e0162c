"""Data-quality checks. Each returns issue rows per (symbol, venue, date) slice:
check, severity, count, detail, sample."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.ordered import adjacent_decreases, exact_percentiles
from marketlake.functions.timeutil import SECOND, idiv
from marketlake.sources.arrival import POSITION, position_block

SLICE = ("symbol", "venue", "date")
ISSUE = [*SLICE, "check", "severity", "count", "detail", "sample"]

# Severities in ascending order, and the score each distinct issue costs.
SEVERITIES = ("info", "minor", "major", "critical")
WEIGHTS = {"info": 0.0, "minor": 2.0, "major": 10.0, "critical": 30.0}
# Grade floors.
GRADES = (("A", 95), ("B", 85), ("C", 70), ("D", 50))


def _issue(check: str, severity, count: Column, detail, sample: Column | None = None) -> Column:
    sev = F.lit(severity) if isinstance(severity, str) else severity
    text = F.lit(detail) if isinstance(detail, str) else detail
    empty = F.array().cast("array<double>")
    return F.struct(F.lit(check).alias("check"), sev.alias("severity"), count.cast("long").alias("count"),
                    text.alias("detail"), (empty if sample is None else sample).alias("sample"))


def _found(*issues: Column) -> Column:
    """The issues that fired; a null count means the check does not apply."""
    return F.filter(F.array(*issues), lambda i: F.coalesce(i["count"], F.lit(0)) > 0)


def _rows(stats: DataFrame) -> DataFrame:
    """Slices with an ``issues`` array → one row per issue."""
    return stats.select(*SLICE, F.explode("issues").alias("i")).select(*SLICE, "i.*")


def union_issues(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- bars ----

def bar_steps(bars: DataFrame) -> DataFrame:
    """Bars with the step from the previous bar of the slice and the running length of equal
    closes. A slice is one day of one-second bars, so the calendar bounds its window."""
    w = Window.partitionBy(*SLICE).orderBy("ts_ns")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.lag("close").over(w)
    return (bars.withColumns({"gap_s": (F.col("ts_ns") - F.lag("ts_ns").over(w)) / 1e9,
                              "_rn": F.row_number().over(w),
                              "_new": before.isNull() | (F.col("close") != before)})
            .withColumn("run_length", F.col("_rn") - F.max(F.when(F.col("_new"), F.col("_rn"))).over(upto) + 1)
            .drop("_rn", "_new"))


def bar_diffs(bars: DataFrame) -> DataFrame:
    return bar_steps(bars).select(*SLICE, "ts_ns", "gap_s")


def bar_stats(bars: DataFrame, warn_gap_s: float = 60, major_gap_s: float = 600, rel_warn_k: float = 30.0,
              rel_major_k: float = 120.0) -> DataFrame:
    """Everything the bar checks and the completeness figures need, from one shuffle."""
    body_hi, body_lo = F.greatest("open", "close"), F.least("open", "close")
    hi, lo, vwap, gap = F.col("high"), F.col("low"), F.col("vwap"), F.col("gap_s")
    whole = Window.partitionBy(*SLICE)
    marked = (bar_steps(bars)
              .withColumn("_med", F.median("gap_s").over(whole))
              .withColumn("_warn", F.greatest(F.lit(float(warn_gap_s)), F.col("_med") * rel_warn_k))
              .withColumn("_major", F.greatest(F.lit(float(major_gap_s)), F.col("_med") * rel_major_k))
              .withColumn("_rank", F.row_number().over(whole.orderBy(F.desc_nulls_last("gap_s")))))
    real = gap > 1.5
    return marked.groupBy(*SLICE).agg(
        F.count_if(hi < body_hi - 1e-9).alias("hi"), F.count_if(lo > body_lo + 1e-9).alias("lo"),
        F.count_if(hi < lo - 1e-9).alias("hl"), F.count_if(F.col("volume") < 0).alias("vol"),
        F.count_if((vwap < lo - 1e-6) | (vwap > hi + 1e-6)).alias("vwap"),
        F.count_if(F.least("open", "high", "low", "close") <= 0).alias("px"),
        F.count(F.lit(1)).alias("bars"), F.count_if(gap == 0).alias("dup"),
        F.count_if(F.pmod("ts_ns", F.lit(SECOND)) != 0).alias("off"),
        F.count_if(real & (gap >= F.col("_warn"))).alias("n_warn"),
        F.count_if(real & (gap >= F.col("_major"))).alias("n_major"),
        F.max(gap).alias("longest_gap"), F.first("_med").alias("med"), F.first("_major").alias("major"),
        F.reverse(F.array_sort(F.collect_list(  # at most five values
            F.when(real & (F.col("_rank") <= 5), F.round("gap_s", 1))))).alias("top"),
        F.max("run_length").alias("longest_run"), F.min("ts_ns").alias("lo_ns"), F.max("ts_ns").alias("hi_ns"))


def _ohlc_issues() -> list[Column]:
    return [_issue("bar.high_below_body", "major", F.col("hi"), "high is below max(open, close)"),
            _issue("bar.low_above_body", "major", F.col("lo"), "low is above min(open, close)"),
            _issue("bar.high_below_low", "critical", F.col("hl"), "high is below low"),
            _issue("bar.negative_volume", "critical", F.col("vol"), "volume is negative"),
            _issue("bar.vwap_outside_hl", "major", F.col("vwap"), "vwap is outside [low, high]"),
            _issue("bar.nonpositive_price", "critical", F.col("px"), "a bar price is not positive")]


def _time_issues() -> list[Column]:
    many = F.col("bars") >= 2
    return [_issue("bar.timestamps_out_of_order", "major", F.when(many, F.col("n_decreases")),
                   "bar times step backwards"),
            _issue("bar.duplicate_timestamps", "major", F.when(many, F.col("dup")), "bars share a timestamp"),
            _issue("bar.timestamp_off_second_grid", "minor", F.when(many, F.col("off")),
                   "bar time is not a whole second")]


def _gap_issue() -> Column:
    detail = F.format_string("%d gaps between bars (median %.1fs, longest %.0fs; %d of them >= %.0fs)",
                             "n_warn", "med", "longest_gap", "n_major", "major")
    severity = F.when(F.col("n_major") > 0, "major").otherwise("minor")
    return _issue("bar.gaps", severity, F.col("n_warn"), detail, F.col("top"))


def _flat_issue(min_run: int) -> Column:
    detail = F.format_string("%d consecutive bars share one close", "longest_run")
    return _issue("bar.flatline", "minor", F.when(F.col("longest_run") >= min_run, F.col("longest_run")), detail)


def _with_arrival_order(stats: DataFrame, rows: DataFrame, arrival: Sequence[str] | None, per_append: bool = False
                        ) -> DataFrame:
    """Backward steps exist only in the order of arrival; without ``arrival`` that check is off.

    The last ``arrival`` column numbers the rows within the others, or is their position. ``per_append`` looks at every append alone: a rebuild
    starts over at the first second, which is no fault.
    """
    if arrival is None:
        return stats.withColumn("n_decreases", F.lit(0))
    *outer, row = arrival
    keys = [*SLICE, *outer] if per_append else list(SLICE)
    steps = adjacent_decreases(rows, keys, "ts_ns", F.struct(*outer) if outer and not per_append else None, row,
                               block=position_block(row) if row == POSITION else None)
    if per_append:
        steps = steps.groupBy(*SLICE).agg(F.sum("n_decreases").alias("n_decreases"))
    return stats.join(steps, list(SLICE), "left")


def check_bar_ohlc(bars: DataFrame) -> DataFrame:
    return _rows(bar_stats(bars).withColumn("issues", _found(*_ohlc_issues())))


def check_bar_timestamps(bars: DataFrame, arrival: Sequence[str] | None = None) -> DataFrame:
    stats = _with_arrival_order(bar_stats(bars), bars, arrival, per_append=True)
    return _rows(stats.withColumn("issues", _found(*_time_issues())))


def check_bar_gaps(bars: DataFrame, **thresholds) -> DataFrame:
    """Gaps long both in absolute terms and relative to the slice's median gap."""
    return _rows(bar_stats(bars, **thresholds).withColumn("issues", _found(_gap_issue())))


def check_flatline(bars: DataFrame, min_run: int = 120) -> DataFrame:
    return _rows(bar_stats(bars).withColumn("issues", _found(_flat_issue(min_run))))


def bar_slices(bars: DataFrame, arrival: Sequence[str] | None = None, min_run: int = 120, **thresholds) -> DataFrame:
    """Bar statistics with the issues of all bar checks."""
    stats = _with_arrival_order(bar_stats(bars, **thresholds), bars, arrival, per_append=True)
    return stats.withColumn("issues", _found(*_ohlc_issues(), *_time_issues(), _gap_issue(), _flat_issue(min_run)))


# ---- trades ----

def lag_p99_ms(trades: DataFrame) -> DataFrame:
    """Exact 99th percentile of the receive lag, whatever the variety and spread of the lags."""
    lag = trades.select(*SLICE, (F.col("recv_ns") - F.col("ts_ns")).alias("lag_ns"))
    p = exact_percentiles(lag, SLICE, "lag_ns", {"p99_ns": 0.99})
    return p.select(*SLICE, (F.col("p99_ns") / 1e6).alias("p99_ms"))


def trade_stats(trades: DataFrame, stale_ms: float = 5000, min_trades: int = 20,
                max_rel: float = 0.5) -> DataFrame:
    """Counts per slice and prints over ``max_rel`` off the slice median. Trades are merged per
    price first, so a hot slice meets in one place only as its distinct prices."""
    real_id = F.when(F.col("trade_id") != "", F.col("trade_id"))
    lag_ms = (F.col("recv_ns") - F.col("ts_ns")) / 1e6
    per_price = trades.groupBy(*SLICE, "price").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("size") <= 0).alias("sz"),
        F.count_if(~F.col("side").isin(-1, 0, 1)).alias("side"), F.count_if(lag_ms > stale_ms).alias("stale"),
        F.count(real_id).alias("ids"))
    whole = Window.partitionBy(*SLICE)
    marked = (per_price.withColumn("_med", F.percentile("price", F.lit(0.5), F.col("n")).over(whole))
              .withColumn("_all", F.sum("n").over(whole)))
    wild = ((F.col("_all") >= min_trades) & (F.col("_med") > 0)
            & (F.abs(F.col("price") - F.col("_med")) / F.col("_med") > max_rel))

    def trades_where(c: Column) -> Column:
        return F.sum(F.when(c, F.col("n")).otherwise(0))

    return marked.groupBy(*SLICE).agg(
        F.sum("n").alias("n_trades"), trades_where(F.col("price") <= 0).alias("px"),
        trades_where(wild).alias("n_extreme"), *[F.sum(c).alias(c) for c in ("sz", "side", "stale", "ids")])


def trade_slices(trades: DataFrame, arrival: Sequence[str] | None = None, stale_ms: float = 5000,
                 max_rel: float = 0.5, min_trades: int = 20) -> DataFrame:
    keys = list(SLICE)
    real_id = F.when(F.col("trade_id") != "", F.col("trade_id"))
    unique = trades.groupBy(*keys).agg(F.count_distinct(real_id).alias("unique_ids"))
    stats = (trade_stats(trades, stale_ms, min_trades, max_rel).join(unique, keys).join(lag_p99_ms(trades), keys, "left")
             .withColumn("dup", F.col("ids") - F.col("unique_ids")))
    stats = _with_arrival_order(stats, trades, arrival)
    lag_detail = F.format_string(f"%d trades received more than {stale_ms / 1000:g}s late (p99 %.0f ms)", "stale", "p99_ms")
    return stats.withColumn("issues", _found(
        _issue("trade.nonpositive_price", "critical", F.col("px"), "trade price is not positive"),
        _issue("trade.nonpositive_size", "major", F.col("sz"), "trade size is not positive"),
        _issue("trade.bad_side", "minor", F.col("side"), "side is not one of -1, 0, 1"),
        _issue("trade.timestamps_out_of_order", "minor", F.col("n_decreases"), "stored trades step backwards"),
        _issue("trade.duplicate_trade_id", "major", F.col("dup"), "venue trade id repeats in the slice"),
        _issue("trade.extreme_price", "major", F.col("n_extreme"),
               f"price is over {max_rel * 100:g}% off the slice median"),
        _issue("trade.high_receive_lag", "minor", F.col("stale"), lag_detail)))


def check_trades(trades: DataFrame, arrival: Sequence[str] | None = None, **thresholds) -> DataFrame:
    return _rows(trade_slices(trades, arrival, **thresholds))


# ---- quotes ----

def quote_slices(quotes: DataFrame, wide_bps: float = 500) -> DataFrame:
    bid, ask = F.col("bid_px"), F.col("ask_px")
    spread = (ask - bid) / F.nullif((bid + ask) / 2, F.lit(0.0)) * 1e4
    stats = quotes.groupBy(*SLICE).agg(
        F.count(F.lit(1)).alias("n_quotes"),
        F.count_if(ask < bid - 1e-12).alias("crossed"), F.count_if(ask == bid).alias("locked"),
        F.count_if((bid <= 0) | (ask <= 0)).alias("px"), F.count_if(spread > wide_bps).alias("wide"))
    return stats.withColumn("issues", _found(
        _issue("quote.crossed_book", "major", F.col("crossed"), "ask is below bid"),
        _issue("quote.locked_book", "info", F.col("locked"), "ask equals bid"),
        _issue("quote.nonpositive_price", "critical", F.col("px"), "bid or ask is not positive"),
        _issue("quote.implausible_spread", "minor", F.col("wide"), f"spread is over {wide_bps:g} bps")))


def check_quotes(quotes: DataFrame, wide_bps: float = 500) -> DataFrame:
    return _rows(quote_slices(quotes, wide_bps))


# ---- tape against venues ----

def second_extremes(bars: DataFrame) -> DataFrame:
    """Per (symbol, date, second): venue close extremes and, next to them, the tape close."""
    tape = F.col("venue") == "agg"
    other = F.when(~tape, F.col("venue"))
    return bars.groupBy("ts_ns", "symbol", "date").agg(
        F.min(F.when(~tape, F.col("close"))).alias("lo"), F.max(F.when(~tape, F.col("close"))).alias("hi"),
        F.max(F.when(tape, F.col("close"))).alias("tape_close"), F.min(other).alias("venue_a"),
        F.max(other).alias("venue_z"), F.count_if(tape).alias("n_tape"), F.count_if(~tape).alias("n_venue_bars"))


def tape_stats(bars: DataFrame, warn_bps: float = 50.0) -> DataFrame:
    """Per (symbol, date) with a tape: breaches of the venue range, dispersion and coverage of
    the union of venue seconds. The p99 is over the seconds of one day, at most 86400."""
    def slack(c: str) -> Column:
        return F.abs(c) * 1e-6 + 1e-9

    breach = ((F.col("tape_close") < F.col("lo") - slack("lo"))
              | (F.col("tape_close") > F.col("hi") + slack("hi")))
    bps = (F.col("hi") - F.col("lo")) / F.nullif((F.col("lo") + F.col("hi")) / 2, F.lit(0.0)) * 1e4
    seen = F.col("n_venue_bars") > 0
    return (second_extremes(bars).withColumn("bps", bps).groupBy("symbol", "date").agg(
                F.count_if(breach).alias("n_breach"), F.count_if(F.col("bps") > warn_bps).alias("n_wide"),
                F.percentile("bps", F.lit(0.99)).alias("p99"),
                (F.min("venue_a") < F.max("venue_z")).alias("two_series"),
                F.sum("n_tape").alias("tape_bars"), F.count_if(seen).alias("union_seconds"),
                F.count_if(seen & (F.col("n_tape") > 0)).alias("covered_seconds"))
            .where(F.col("tape_bars") > 0)
            .withColumn("venue", F.lit("agg"))
            .withColumn("agg_coverage_of_union_pct",
                        F.when(F.col("union_seconds") > 0,
                               F.round(F.col("covered_seconds") * 100.0 / F.col("union_seconds"), 2))))


def _range_issue() -> Column:
    return _issue("agg.outside_venue_range", "major", F.when(F.col("two_series"), F.col("n_breach")),
                  "tape close is outside the venue closes")


def _dispersion_issue(warn_bps: float = 50.0) -> Column:
    severity = F.when(F.coalesce("p99", F.lit(0.0)) < 200, "minor").otherwise("major")
    detail = F.format_string(f"%d seconds with venue closes over {warn_bps:.0f} bps apart (p99 %.0f bps)",
                             "n_wide", F.coalesce("p99", F.lit(0.0)))
    return _issue("xvenue.dispersion", severity, F.when(F.col("two_series"), F.col("n_wide")), detail)


def check_tape_range(bars: DataFrame) -> DataFrame:
    """Tape closes outside the venue closes of the same second; needs two venue series."""
    return _rows(tape_stats(bars).withColumn("issues", _found(_range_issue())))


def check_dispersion(bars: DataFrame, warn_bps: float = 50.0) -> DataFrame:
    """Seconds whose venue closes differ by more than ``warn_bps`` of mid."""
    return _rows(tape_stats(bars, warn_bps).withColumn("issues", _found(_dispersion_issue(warn_bps))))


def tape_slices(bars: DataFrame) -> DataFrame:
    return tape_stats(bars).withColumn("issues", _found(_range_issue(), _dispersion_issue()))


def tape_coverage(bars: DataFrame) -> DataFrame:
    """Per (symbol, date): share of the seconds with any venue bar that the tape covers too."""
    return tape_stats(bars).select(*SLICE, "union_seconds", "covered_seconds", "agg_coverage_of_union_pct")


def run_checks(bars: DataFrame | None = None, trades: DataFrame | None = None,
               quotes: DataFrame | None = None, arrival: Sequence[str] | None = None,
               thresholds: dict[str, dict] | None = None) -> DataFrame:
    """Every check that applies to the tables given, one row per issue.

    ``arrival`` names the order-of-arrival columns of bars and trades (``Lake.arrivals``); ``thresholds`` has
    arguments of ``bar_slices``, ``trade_slices`` and ``quote_slices`` under bars, trades and quotes.
    """
    given = thresholds or {}
    found = []
    if bars is not None:
        found += [_rows(bar_slices(bars, arrival, **given.get("bars", {}))), _rows(tape_slices(bars))]
    if trades is not None:
        found.append(_rows(trade_slices(trades, arrival, **given.get("trades", {}))))
    if quotes is not None:
        found.append(_rows(quote_slices(quotes, **given.get("quotes", {}))))
    if not found:
        raise ValueError("give at least one table to check")
    return union_issues(*found).select(*ISSUE)


def severity_rank(c="severity") -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), F.col(c)).cast("int") - 1


def sorted_issues(issues: DataFrame) -> DataFrame:
    return issues.orderBy(*SLICE, severity_rank().desc(), "check")


# ---- scoring ----

def grade_of(score: Column) -> Column:
    out = F.when(score >= GRADES[0][1], GRADES[0][0])
    for letter, floor in GRADES[1:]:
        out = out.when(score >= floor, letter)
    return out.otherwise("F")


def _completeness_columns(stats: DataFrame) -> DataFrame:
    span = idiv(F.col("hi_ns") - F.col("lo_ns"), SECOND) + 1
    return (stats.withColumn("span_seconds", span).withColumn("expected_bars", F.col("span_seconds"))
            .withColumn("max_gap_seconds", F.coalesce("longest_gap", F.lit(0.0)).cast("long"))
            .withColumn("completeness_pct",
                        F.round(F.least(F.lit(1.0), F.col("bars") / F.col("expected_bars")) * 100, 4)))


COMPLETENESS = ["bars", "expected_bars", "completeness_pct", "max_gap_seconds", "span_seconds"]


def completeness(bars: DataFrame) -> DataFrame:
    """Per slice: bars, expected bars over its span, density and longest gap."""
    return _completeness_columns(bar_stats(bars)).select(*SLICE, *COMPLETENESS)


def _ordered(issues: Column) -> Column:
    """Most severe first, then by name; samples cut to five."""
    def rank(i: Column) -> Column:
        return F.array_position(F.array(*[F.lit(s) for s in SEVERITIES]), i["severity"])

    keyed = F.transform(issues, lambda i: F.struct((-rank(i)).alias("k"), i["check"].alias("check"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda x: F.struct(
        x["i"]["check"].alias("check"), x["i"]["severity"].alias("severity"), x["i"]["count"].alias("count"),
        x["i"]["detail"].alias("detail"), F.slice(x["i"]["sample"], 1, 5).alias("sample")))


def judge(slices: DataFrame) -> DataFrame:
    """Add points lost and issue counts to slices that carry an ``issues`` array."""
    weight = F.create_map(*[F.lit(x) for kv in WEIGHTS.items() for x in kv])
    penalty = F.aggregate("issues", F.lit(0.0), lambda acc, i: acc + F.element_at(weight, i["severity"]))

    def of(severity: str) -> Column:
        return F.size(F.filter("issues", lambda i: i["severity"] == severity)).cast("long")

    return slices.withColumns({
        "penalty": penalty, "n_issues": F.size("issues").cast("long"),
        **{f"n_{s}": of(s) for s in SEVERITIES}, "issues": _ordered(F.col("issues"))})


def _joined_slices(bars: DataFrame, trades: DataFrame | None, quotes: DataFrame | None,
                   arrival: Sequence[str] | None, how: str, thresholds: dict[str, dict] | None = None) -> DataFrame:
    """Slice statistics of every table side by side, their issue arrays put together.
    One row per slice on either side of each join."""
    keys, given = list(SLICE), thresholds or {}
    out = _completeness_columns(bar_slices(bars, arrival, **given.get("bars", {}))).select(*keys, *COMPLETENESS, F.col("issues").alias("_i0"))
    tape = tape_slices(bars).select(*keys, "union_seconds", "agg_coverage_of_union_pct",
                                    F.col("issues").alias("_i1"))
    out = out.join(tape, keys, "left")
    none = F.lit(0).cast("long")
    found = ["_i0", "_i1"]
    if trades is None:
        out = out.withColumn("n_trades", none)
    else:
        out = out.join(trade_slices(trades, arrival, **given.get("trades", {})).select(*keys, "n_trades", F.col("issues").alias("_i2")),
                       keys, how)
        found.append("_i2")
    if quotes is None:
        out = out.withColumn("n_quotes", none)
    else:
        out = out.join(quote_slices(quotes, **given.get("quotes", {})).select(*keys, "n_quotes", F.col("issues").alias("_i3")),
                       keys, how)
        found.append("_i3")
    nothing = F.from_json(F.lit("[]"), ISSUE_JSON)
    return (out.withColumn("issues", F.concat(*[F.coalesce(c, nothing) for c in found])).drop(*found)
            .fillna(0, ["n_trades", "n_quotes"]))


def slice_scores(bars: DataFrame, trades: DataFrame | None = None, quotes: DataFrame | None = None) -> DataFrame:
    """Per slice with an issue in any table: points lost, issue counts and the ordered issues."""
    judged = judge(_joined_slices(bars, trades, quotes, None, "full"))
    return judged.where(F.col("n_issues") > 0).select(
        *SLICE, "penalty", "n_issues", *[f"n_{s}" for s in SEVERITIES], "issues")


def score_cards(bars: DataFrame, trades: DataFrame | None = None, quotes: DataFrame | None = None,
                arrival: Sequence[str] | None = None, thresholds: dict[str, dict] | None = None) -> DataFrame:
    """One card per slice of ``bars``, all slices in one job; ``arrival`` and ``thresholds`` as in ``run_checks``."""
    is_tape = F.col("venue") == "agg"
    base = F.when(is_tape, F.coalesce("agg_coverage_of_union_pct", F.lit(100.0))).otherwise(F.lit(100.0))
    score = F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), F.col("score_base_pct") - F.col("penalty"))), 2)
    return (judge(_joined_slices(bars, trades, quotes, arrival, "left", thresholds))
            .withColumn("score_base_pct", base).withColumn("score", score)
            .withColumn("grade", grade_of(F.col("score")))
            .withColumn("score_basis", F.when(is_tape, "coverage_of_contributing_venues")
                        .otherwise("clean_baseline"))
            .withColumn("day_coverage_pct", F.round(F.col("span_seconds") * 100.0 / 86400, 2))
            .drop("penalty"))


ISSUE_JSON = "array<struct<check:string,severity:string,count:bigint,detail:string,sample:array<double>>>"


def daily_quality_rows(cards: DataFrame, computed_at_ns: int | None = None) -> DataFrame:
    """Cards in the layout of the daily_quality table."""
    now = F.lit(computed_at_ns) if computed_at_ns is not None else F.unix_micros(F.current_timestamp()) * 1000
    return cards.select("date", "symbol", "venue", "score", "grade", "score_base_pct", "bars", "expected_bars",
                        "completeness_pct", "max_gap_seconds", "n_issues", "n_critical",
                        F.to_json("issues").alias("issues_json"), now.cast("long").alias("computed_at_ns"))


def quality_summary(cards: DataFrame) -> DataFrame:
    """One row over all cards. The distinct lists are of symbols, venues and dates."""
    def names(c: str) -> Column:
        return F.array_sort(F.collect_set(c))

    return cards.agg(
        F.count(F.lit(1)).alias("slices"), names("symbol").alias("symbols"), names("venue").alias("venues"),
        names("date").alias("dates"), F.round(F.avg("score"), 2).alias("mean_score"),
        F.round(F.min("score"), 2).alias("min_score"),
        *[F.count_if(F.col("grade") == g).alias(f"grade_{g.lower()}") for g in "ABCDF"],
        F.coalesce(F.sum("n_critical"), F.lit(0)).alias("total_critical_issues"))


def offenders(daily: DataFrame, fail_on: str = "critical") -> DataFrame:
    """Persisted issues at or above a severity, one row each."""
    if fail_on not in SEVERITIES:
        raise ValueError(f"fail_on must be one of {list(SEVERITIES)}")
    return (daily.select("symbol", "venue", "date", F.explode(F.from_json("issues_json", ISSUE_JSON)).alias("i"))
            .select("symbol", "venue", "date", "i.check", "i.severity", "i.count")
            .where(severity_rank() >= SEVERITIES.index(fail_on)))


def gate(daily: DataFrame, fail_on: str = "critical") -> bool:
    """True when nothing at or above the severity is recorded."""
    return offenders(daily, fail_on).isEmpty()


def latest_cards(daily: DataFrame) -> DataFrame:
    """The newest card of each (symbol, venue); merges map-side, no window over the history."""
    rest = ["score", "grade", "completeness_pct", "n_critical", "date"]
    return (daily.groupBy("symbol", "venue").agg(F.max_by(F.struct(*rest), F.col("date")).alias("c"))
            .select("symbol", "venue", "c.*"))
