"""Batch build: trades → venue bars and tape → coverage → quality → manifest.

Every step covers all (symbol, date) slices in one job and reads what the step
before it stored, so nothing is computed twice and a lost executor only costs tasks.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timeutil import date_of
from marketlake.operators import coverage as C
from marketlake.operators import quality as Q
from marketlake.operators import tape as T
from marketlake.operators.bars import bars_from_trades
from marketlake.operators.refdata import listed_mappings, seed_symbol_map
from marketlake.schemas import META_SCHEMAS, conform
from marketlake.session import shared_dir
from marketlake.sources.store import ARRIVAL, Files, Lake, materialize


def slices_present(trades: DataFrame) -> DataFrame:
    return trades.select("symbol", "date").distinct().orderBy("symbol", "date")


def build_bars(lake: Lake, symbols: list[str] | None = None, dates: list[str] | None = None) -> None:
    """Per-venue bars and the tape of every slice, appended; the run is logged per slice."""
    if not lake.exists("trades"):
        return
    trades = lake.arrivals("trades")
    if symbols:
        trades = trades.where(F.col("symbol").isin(symbols))
    if dates:
        trades = trades.where(F.col("date").isin(dates))
    now = time.time_ns()
    # both are one row per second: stored once here, then read for the table and for the log
    venue_bars = materialize(bars_from_trades(trades, ARRIVAL).withColumn("ingested_at_ns", F.lit(now)),
                             venue_path := shared_dir(lake.spark, "venue-bars"))
    tape = materialize(T.tape_with_diagnostics(T.spot_only(trades), arrival=ARRIVAL)
                       .withColumn("ingested_at_ns", F.lit(now)), tape_path := shared_dir(lake.spark, "tape"))
    lake.append("bars_1s", venue_bars.unionByName(
        tape.where(F.col("n_kept") > 0).select(*venue_bars.columns)))
    log_build(lake, tape, venue_bars, now)
    for copy in (venue_path, tape_path):
        Files(lake.spark, copy).delete(copy)


def log_build(lake: Lake, tape: DataFrame, venue_bars: DataFrame, now: int) -> None:
    """One backfill correction per slice built, with what the filter dropped in its note."""
    keys = ["symbol", "date"]
    dated = venue_bars.withColumn("date", date_of("ts_ns"))
    per_venue = dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("venue_bars"))
    rows = per_venue.join(T.run_summary(tape.withColumn("date", date_of("ts_ns")), T.spot_only(dated), keys), keys,
                          "left").fillna(0)
    note = F.format_string("rebuilt %s: per_venue=%d agg=%d venues=%s dropped=%d", "date", "venue_bars", "agg_bars",
                           F.coalesce(F.array_join("contributing_venues", ","), F.lit("")),
                           "trades_dropped_by_filter")
    lake.put_meta("corrections", conform(rows.select(
        F.concat_ws("-", F.lit(str(now)), "symbol", "date").alias("correction_id"),
        F.lit(now).alias("recorded_at_ns"), F.lit(0).alias("effective_from_ns"), F.lit(0).alias("effective_to_ns"),
        F.lit("bars_1s").alias("table_name"), "symbol", F.lit("agg").alias("venue"),
        F.lit("backfill").alias("kind"), F.lit("info").alias("severity"),
        (F.col("venue_bars") + F.col("agg_bars")).alias("rows_affected"), note.alias("note")), "corrections"))


def write_daily_quality(lake: Lake, symbols: list[str] | None = None, dates: list[str] | None = None,
                        json_dir: str | None = None) -> DataFrame:
    """Score every stored slice, upsert the cards and mirror them as JSON; dates not scored keep theirs."""
    def pick(df: DataFrame) -> DataFrame:
        if symbols:
            df = df.where(F.col("symbol").isin(symbols))
        return df.where(F.col("date").isin(dates)) if dates else df

    path = shared_dir(lake.spark, "cards")  # one row per slice, read for the table and for the files
    cards = materialize(Q.score_cards(pick(lake.arrivals("bars_1s")), pick(lake.arrivals("trades")),
                                      pick(lake.table("quotes")), arrival=ARRIVAL), path)
    lake.put_meta("daily_quality", Q.daily_quality_rows(cards))
    if json_dir:
        (cards.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").json(json_dir))
    Files(lake.spark, path).delete(path)
    return pick(lake.meta("daily_quality"))


def write_coverage(lake: Lake) -> DataFrame:
    rows = C.stored_coverage(lake).withColumn("computed_at_ns", F.lit(time.time_ns()))
    lake.put_meta("coverage", rows, replace=True)
    return lake.meta("coverage")


def manifest(lake: Lake, params: dict | None = None) -> str:
    """JSON text of counts and summaries; the only place results reach the driver, as a few scalars."""
    cov = C.summary(lake.meta("coverage")).first().asDict()
    quality = Q.quality_summary(lake.meta("daily_quality")).first().asDict()
    bars = lake.table("bars_1s").agg(
        F.count_if(F.col("venue") != "agg").alias("per_venue_1s"), F.count_if(F.col("venue") == "agg").alias("agg_1s"),
        F.count_distinct("symbol", "date").alias("slices")).first().asDict()
    return json.dumps({"built_at_ns": time.time_ns(), "params": params or {}, "bars_built": bars,
                       "symbol_map_mappings": lake.meta("symbol_map").count(), "coverage": cov,
                       "quality": quality}, sort_keys=True, default=str)


def build_dataset(lake: Lake, params: dict | None = None) -> str:
    seeded = seed_symbol_map(lake.meta("symbol_map"), listed_mappings(lake.spark))
    lake.put_meta("symbol_map", seeded.select(*META_SCHEMAS["symbol_map"].fieldNames()))
    build_bars(lake)
    write_coverage(lake)
    write_daily_quality(lake)
    return manifest(lake, params)
