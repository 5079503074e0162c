"""Query functions over the canonical tables.

Common contract: ``[start, end)`` on ``ts_ns``; an int is nanoseconds, anything
else is parsed with naive times as UTC. ``venues``: None or 'all' means no filter,
a string means one venue, an empty list matches nothing. Every function takes the
table as a DataFrame and adds a display column ``ts``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.functions.timeutil import date_text, floor_ns, parse_timeframe, to_ns, ts_of
from marketlake.operators.resample import resample_bars
from marketlake.schemas import BAR_COLUMNS
from marketlake.sources.venues import PERP_VENUES, known_venue

Venues = Iterable[str] | str | None


def in_range(df: DataFrame, start, end) -> DataFrame:
    """Half-open time range, plus the matching date range when the table is date-partitioned."""
    lo, hi = to_ns(start), to_ns(end)
    out = df.where((F.col("ts_ns") >= lo) & (F.col("ts_ns") < hi))
    if "date" in df.columns and hi > lo:
        out = out.where(F.col("date").cast("string").between(date_text(lo), date_text(hi - 1)))
    return out


def of_venues(df: DataFrame, venues: Venues) -> DataFrame:
    if venues is None or (isinstance(venues, str) and venues == "all"):
        return df
    wanted = [venues] if isinstance(venues, str) else list(venues)
    return df.where(F.col("venue").isin(wanted)) if wanted else df.where(F.lit(False))


def visible_asof(df: DataFrame, asof) -> DataFrame:
    """Rows a reader at ``asof`` would have seen; rows without an ingest time always."""
    if asof is None:
        return df
    seen = F.col("ingested_at_ns")
    return df.where(seen.isNull() | (seen <= to_ns(asof)))


def latest_versions(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the most recently ingested; nulls lose. Merges map-side."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(F.coalesce("ingested_at_ns", F.lit(-1)).alias("i"),
                                           F.struct(*rest).alias("r"))).alias("_r"))
    return picked.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*df.columns)


def with_ts(df: DataFrame, tz: str = "UTC") -> DataFrame:
    ts = ts_of("ts_ns")
    return df.withColumn("ts", ts if tz == "UTC" else F.from_utc_timestamp(ts, tz))


def _read(table: DataFrame, symbol: str, start, end, venues: Venues, asof, columns: Sequence[str],
          order: Sequence[str], tz: str) -> DataFrame:
    rows = visible_asof(of_venues(in_range(table.where(F.col("symbol") == symbol), start, end), venues), asof)
    return with_ts(rows.select(*columns), tz).orderBy(*order)


def get_trades(trades: DataFrame, symbol: str, start, end, venues: Venues = None, tz: str = "UTC",
               asof=None) -> DataFrame:
    return _read(trades, symbol, start, end, venues, asof,
                 ["ts_ns", "recv_ns", "venue", "price", "size", "side", "trade_id"], ["ts_ns", "venue"], tz)


def get_quotes(quotes: DataFrame, symbol: str, start, end, venues: Venues = None, tz: str = "UTC",
               asof=None) -> DataFrame:
    return _read(quotes, symbol, start, end, venues, asof,
                 ["ts_ns", "recv_ns", "venue", "bid_px", "ask_px", "bid_sz", "ask_sz"],
                 ["ts_ns", "venue"], tz)


def get_funding(funding: DataFrame, symbol: str, start, end, venues: Venues = "all", tz: str = "UTC",
                asof=None) -> DataFrame:
    """Long format, one row per venue and settlement; never averaged across venues."""
    return _read(funding, symbol, start, end, venues, asof,
                 ["ts_ns", "recv_ns", "venue", "funding_rate", "mark_price", "next_ts_ns"],
                 ["ts_ns", "venue"], tz)


def funding_wide(funding: DataFrame, venues: Sequence[str] = PERP_VENUES) -> DataFrame:
    """One column of rates per venue, a row per settlement and symbol; of repeated rates the last ingested.

    Naming the venues saves a job to discover them; a venue that is not named stops the query.
    """
    return (funding.withColumn("venue", known_venue(venues)).groupBy("ts_ns", "symbol").pivot("venue", list(venues))
            .agg(F.max_by("funding_rate", F.struct("ingested_at_ns", "recv_ns", "funding_rate"))))


def get_open_interest(oi: DataFrame, symbol: str, start, end, venues: Venues = "all", tz: str = "UTC",
                      asof=None) -> DataFrame:
    return _read(oi, symbol, start, end, venues, asof, ["ts_ns", "venue", "oi_base", "oi_quote"],
                 ["ts_ns", "venue"], tz)


def get_ref_bars(ref: DataFrame, symbol: str, start, end, interval: str = "1m", venues: Venues = None,
                 tz: str = "UTC", asof=None) -> DataFrame:
    return _read(ref.where(F.col("interval") == interval), symbol, start, end, venues, asof,
                 ["ts_ns", "venue", "open", "high", "low", "close", "volume", "trades"],
                 ["venue", "ts_ns"], tz)


def get_book_snapshots(books: DataFrame, symbol: str, start, end, venue: str, levels: int | None = None,
                       tz: str = "UTC", asof=None) -> DataFrame:
    """``levels`` shortens both sides; the stored ``depth`` is reported unchanged."""
    rows = _read(books, symbol, start, end, venue, asof,
                 ["ts_ns", "recv_ns", "venue", "depth", "bids", "asks"], ["ts_ns"], tz)
    if levels is not None:
        rows = rows.withColumns({s: F.slice(s, 1, levels) for s in ("bids", "asks")})
    return rows


def list_book_symbols(books: DataFrame) -> DataFrame:
    return books.select("symbol", "venue").distinct().orderBy("symbol", "venue")


def venue_status(status: DataFrame, since=None) -> DataFrame:
    rows = status if since is None else status.where(F.col("ts_ns") >= to_ns(since))
    return rows.orderBy("ts_ns")


def get_bars(bars: DataFrame, symbol: str | Sequence[str], start, end, timeframe: str = "1m",
             sources: Iterable[str] | None = None, fields: Sequence[str] | None = None,
             fill: str = "none", tz: str = "UTC", asof=None, versions: str = "all",
             mask: str = "max") -> DataFrame:
    """Bars of a symbol at any timeframe, one series per source (default the tape).

    The as-of cut-off applies to the one-second bars before resampling. ``fill``
    works on existing rows only, because empty windows produce none; see
    ``grid_ffill`` for a dense grid. ``versions='latest'`` keeps the newest build
    of every second.
    """
    wanted = ([sources] if isinstance(sources, str) else list(sources)) if sources else ["agg"]
    symbols = [symbol] if isinstance(symbol, str) else list(symbol)
    rows = visible_asof(of_venues(in_range(bars.where(F.col("symbol").isin(symbols)), start, end), wanted),
                        asof).select(*BAR_COLUMNS)
    if versions == "latest":
        rows = latest_versions(rows, ["symbol", "venue", "ts_ns"])
    out = resample_bars(rows, timeframe, mask=mask)
    if fill == "zero":
        out = out.fillna(0)
    elif fill == "ffill":
        # nothing after resampling has a null price, so only the counters can change
        out = out.fillna(0, ["volume", "trades"])
    out = with_ts(out, tz).orderBy("ts_ns", "venue")
    if not fields:
        return out
    # several series are told apart by their venue; columns that bars do not have are left out
    asked = list(fields) if len(wanted) == 1 else [*fields, "venue"]
    return out.select([F.col(c) for i, c in enumerate(asked) if c in out.columns and c not in asked[:i]])


def grid_ffill(bars: DataFrame, timeframe: str, start=None, end=None) -> DataFrame:
    """Dense grid: one row per series and window from its first bar on, prices carried forward.

    Each bar is repeated up to the next one. A series runs to the last window before
    ``end``, or to its own last bar when no end is given.
    """
    frame = parse_timeframe(timeframe)
    step = F.lit(frame.step).cast("long")
    if start is not None:
        bars = bars.where(F.col("ts_ns") >= to_ns(start))
    last = F.col("ts_ns")
    if end is not None:
        bars = bars.where(F.col("ts_ns") < to_ns(end))
        # windows of a series stand a whole number of steps from any of its bars, whatever it is anchored at
        last = F.col("ts_ns") + floor_ns(F.lit(to_ns(end) - 1).cast("long") - F.col("ts_ns"), frame.step)
    rows = resample_bars(bars.select(*BAR_COLUMNS), timeframe)
    # bars of one series: bounded by the calendar, not by trade volume
    following = F.lead("ts_ns").over(Window.partitionBy("symbol", "venue").orderBy("ts_ns"))
    grid = (rows.withColumn("_to", F.coalesce(following - step, last))
            .withColumn("grid_ns", F.explode(F.sequence("ts_ns", "_to", step))))
    real = F.col("grid_ns") == F.col("ts_ns")

    def or_zero(c: str) -> Column:
        return F.when(real, F.col(c)).otherwise(F.lit(0)).alias(c)

    return grid.select(F.col("grid_ns").alias("ts_ns"), "symbol", "venue",
                       *[F.when(real, F.col(c)).otherwise(F.col("close")).alias(c)
                         for c in ("open", "high", "low")],
                       "close", or_zero("volume"), or_zero("trades"), (~real).alias("filled"))
