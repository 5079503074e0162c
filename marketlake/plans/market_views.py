"""Market-shaped views over the driver's ``events`` table.

The texts run unchanged in Spark and in the SQL oracle, so both sides start from
the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import shared_dir
from marketlake.sources.store import materialize

FX_TRADES = """
SELECT ts_ns, ts_ns + (user_id % 7) * 1000000000 AS recv_ns, symbol, venue, price, size,
       CAST(event_id % 3 - 1 AS TINYINT) AS side,
       CASE WHEN event_id % 40 = 0 THEN NULL WHEN event_id % 25 = 0 THEN 'dup'
            ELSE CAST(event_id AS STRING) END AS trade_id,
       ts_ns + 10000000000 AS ingested_at_ns, event_id AS seq,
       CASE WHEN ts_ns < 1700006400000000000 THEN '2023-11-14' ELSE '2023-11-15' END AS date
FROM (SELECT event_id, user_id,
             1700006200000000000 + CAST(floor(event_id / 2.0) AS BIGINT) * 100000000 AS ts_ns,
             concat('SYM', CAST(user_id % 3 AS STRING)) AS symbol,
             CASE event_type WHEN 'click' THEN 'binance' WHEN 'error' THEN 'coinbase'
                  WHEN 'purchase' THEN 'kraken' WHEN 'signup' THEN 'okx' ELSE 'bybit' END AS venue,
             100 + value / 100 AS price, (event_id % 20) / CAST(10 AS DOUBLE) AS size
      FROM {events}) e
"""

FX_QUOTES = """
SELECT ts_ns, recv_ns, symbol, venue, price AS bid_px,
       price + (seq % 11 - 1) * CAST(0.01 AS DOUBLE) AS ask_px,
       CAST(1 + seq % 5 AS DOUBLE) AS bid_sz, CAST(1 + seq % 3 AS DOUBLE) AS ask_sz,
       ingested_at_ns, seq, date
FROM {fx_trades} WHERE venue <> 'bybit'
"""

FX_FUNDING = """
SELECT ts_ns, max(recv_ns) AS recv_ns, concat(symbol, '-PERP') AS symbol, venue,
       avg(price) / CAST(1000000 AS DOUBLE) AS funding_rate, max(price) AS mark_price,
       ts_ns + 8000000000 AS next_ts_ns, max(ingested_at_ns) AS ingested_at_ns
FROM (SELECT ts_ns - ts_ns % 8000000000 AS ts_ns, recv_ns, symbol, venue, price, ingested_at_ns
      FROM {fx_trades} WHERE venue IN ('bybit', 'okx')) f
GROUP BY ts_ns, symbol, venue
"""

# One open-interest reading per perp feed and 4 s step.
FX_OI = """
SELECT ts_ns, max(recv_ns) AS recv_ns, concat(symbol, '-PERP') AS symbol, venue,
       CAST(sum(1 + seq % 9) AS DOUBLE) AS oi_base, CAST(NULL AS DOUBLE) AS oi_quote,
       max(ingested_at_ns) AS ingested_at_ns
FROM (SELECT ts_ns - ts_ns % 4000000000 AS ts_ns, recv_ns, symbol, venue, seq, ingested_at_ns
      FROM {fx_trades} WHERE venue IN ('bybit', 'okx')) f
GROUP BY ts_ns, symbol, venue
"""

# Feed status: every 20 s each feed is up unless it printed on an 'odd' user in that step.
FX_STATUS = """
SELECT ts_ns, venue, symbol, 'trades' AS stream, max(user_mod) < 6 AS up,
       CAST(count(*) AS DOUBLE) / 20 AS coverage_pct, CAST(NULL AS STRING) AS notes
FROM (SELECT ts_ns - ts_ns % 20000000000 AS ts_ns, venue, symbol,
             CASE WHEN seq % 20 = 7 THEN (recv_ns - ts_ns) // 1000000000 ELSE 0 END AS user_mod
      FROM {fx_trades}) s
GROUP BY ts_ns, venue, symbol
"""

# Corrections: one logged restatement per (symbol, venue, minute).
FX_CORRECTIONS = """
SELECT concat(symbol, '/', venue, '/', CAST(minute_ns AS STRING)) AS correction_id,
       minute_ns + 60000000000 AS recorded_at_ns, minute_ns AS effective_from_ns,
       minute_ns + 60000000000 AS effective_to_ns,
       CASE WHEN n % 2 = 0 THEN 'trades' ELSE 'bars_1s' END AS table_name, symbol, venue,
       CASE n % 5 WHEN 0 THEN 'backfill' WHEN 1 THEN 'restatement' WHEN 2 THEN 'bad_range'
                  WHEN 3 THEN 'gap' ELSE 'note' END AS kind,
       CASE n % 4 WHEN 0 THEN 'info' WHEN 1 THEN 'minor' WHEN 2 THEN 'major' ELSE 'critical' END AS severity,
       n AS rows_affected, CAST(NULL AS STRING) AS note
FROM (SELECT symbol, venue, ts_ns - ts_ns % 60000000000 AS minute_ns, count(*) AS n
      FROM {fx_trades} GROUP BY 1, 2, 3) c
"""

# Trades under listed canonical symbols; the derivatives venue trades the perpetuals.
FX_LISTED = """
SELECT ts_ns, recv_ns, concat(CASE symbol WHEN 'SYM0' THEN 'BTC-USDT' WHEN 'SYM1' THEN 'ETH-USDT'
       ELSE 'XRP-USDT' END, CASE WHEN venue = 'bybit' THEN '-PERP' ELSE '' END) AS canonical, venue, price, size, seq
FROM {fx_trades}
"""

# symbol_map history: one interval per listed feed and 2-minute step, the last of each feed open.
FX_SYMBOL_MAP = """
SELECT canonical, venue, native, asset_class, base, quote, effective_from_ns,
       CASE WHEN seq_max % 3 = 0 THEN NULL ELSE effective_from_ns + 90000000000 END AS effective_to_ns,
       CAST(NULL AS STRING) AS note
FROM (SELECT canonical, venue, lower(replace(canonical, '-', '')) AS native,
             CASE WHEN canonical LIKE '%-PERP' THEN 'perp' ELSE 'spot' END AS asset_class,
             split_part(canonical, '-', 1) AS base, split_part(canonical, '-', 2) AS quote,
             ts_ns - ts_ns % 120000000000 AS effective_from_ns, max(seq) AS seq_max
      FROM {fx_listed} GROUP BY 1, 2, 3, 4, 5, 6, 7) m
"""

TEXTS = {"fx_listed": FX_LISTED, "fx_symbol_map": FX_SYMBOL_MAP, "fx_trades": FX_TRADES, "fx_quotes": FX_QUOTES, "fx_funding": FX_FUNDING, "fx_oi": FX_OI,
         "fx_status": FX_STATUS, "fx_corrections": FX_CORRECTIONS}

T0 = 1700006200000000000  # first instant of the views


class MarketViews:
    """DataFrames for one data folder, built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str, events: DataFrame | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.events = events if events is not None else spark.read.parquet(f"{sf_dir}/events.parquet")

    def _sql(self, name: str, **sources: DataFrame) -> DataFrame:
        return self.spark.sql(TEXTS[name].replace("//", "div"), **sources)

    @property
    def trades(self) -> DataFrame:
        return self._sql("fx_trades", events=self.events)

    @property
    def quotes(self) -> DataFrame:
        return self._sql("fx_quotes", fx_trades=self.trades)

    @property
    def funding(self) -> DataFrame:
        return self._sql("fx_funding", fx_trades=self.trades)

    @property
    def open_interest(self) -> DataFrame:
        return self._sql("fx_oi", fx_trades=self.trades)

    @property
    def status(self) -> DataFrame:
        return self._sql("fx_status", fx_trades=self.trades)

    @property
    def corrections(self) -> DataFrame:
        return self._sql("fx_corrections", fx_trades=self.trades)

    @property
    def listed(self) -> DataFrame:
        return self._sql("fx_listed", fx_trades=self.trades)

    @property
    def symbol_map(self) -> DataFrame:
        return self._sql("fx_symbol_map", fx_listed=self.listed)

    @property
    def stored_bars(self) -> DataFrame:
        """bars_1s written once, for queries that read it many times, as a build does."""
        return materialize(self.bars, shared_dir(self.spark, "bars"))

    @property
    def books(self) -> DataFrame:
        levels = "transform(sequence(0, 2), j -> struct({p} {op} 0.1D * j AS px, {s} + j AS sz))"
        return self.quotes.select(
            "ts_ns", "recv_ns", "symbol", "venue", F.lit(3).cast("short").alias("depth"),
            F.expr(levels.format(p="bid_px", op="-", s="bid_sz")).alias("bids"),
            F.expr(levels.format(p="ask_px", op="+", s="ask_sz")).alias("asks"), "ingested_at_ns", "seq")

    @property
    def venue_bars(self) -> DataFrame:
        from marketlake.operators.bars import bars_from_trades
        return bars_from_trades(self.trades)

    @property
    def tape(self) -> DataFrame:
        from marketlake.operators.tape import build_tape, spot_only
        return build_tape(spot_only(self.trades))

    @property
    def bars(self) -> DataFrame:
        """bars_1s: per-venue bars and the tape, with the UTC date of each bar."""
        from marketlake.functions.timeutil import date_of
        return self.venue_bars.unionByName(self.tape).withColumn("date", date_of("ts_ns"))
