"""Oracle texts for the store, reference data, health, coverage, status and analytics."""

from __future__ import annotations

from oracle.base import cte, date_of, r, rounded, sql
from oracle.market import S, T0, grid, resampled

SL = "symbol, venue, date"

# Canonical symbol, venue, the venue's own ticker.
LISTED = (
    ("BTC-USDT", "binance", "BTCUSDT"),
    ("BTC-USDT", "bybit", "BTCUSDT"),
    ("BTC-USDT", "kraken", "XBTUSDT"),
    ("BTC-USDT", "okx", "BTC-USDT"),
    ("BTC-USDT", "bitstamp", "btcusdt"),
    ("BTC-USDT", "gemini", "btcusdt"),
    ("BTC-USDT", "bitfinex", "tBTCUST"),
    ("BTC-USD", "coinbase", "BTC-USD"),
    ("BTC-USD", "kraken", "XBTUSD"),
    ("BTC-USD", "bitstamp", "btcusd"),
    ("BTC-USD", "gemini", "btcusd"),
    ("BTC-USD", "bitfinex", "tBTCUSD"),
    ("ETH-USDT", "binance", "ETHUSDT"),
    ("ETH-USDT", "bybit", "ETHUSDT"),
    ("ETH-USDT", "kraken", "ETHUSDT"),
    ("ETH-USDT", "okx", "ETH-USDT"),
    ("ETH-USDT", "bitstamp", "ethusdt"),
    ("ETH-USDT", "gemini", "ethusdt"),
    ("ETH-USDT", "bitfinex", "tETHUST"),
    ("ETH-USD", "coinbase", "ETH-USD"),
    ("ETH-USD", "kraken", "ETHUSD"),
    ("ETH-USD", "bitstamp", "ethusd"),
    ("ETH-USD", "gemini", "ethusd"),
    ("ETH-USD", "bitfinex", "tETHUSD"),
    ("SOL-USDT", "binance", "SOLUSDT"),
    ("SOL-USDT", "bybit", "SOLUSDT"),
    ("SOL-USDT", "okx", "SOL-USDT"),
    ("SOL-USDT", "bitstamp", "solusdt"),
    ("SOL-USDT", "bitfinex", "tSOLUST"),
    ("SOL-USD", "coinbase", "SOL-USD"),
    ("SOL-USD", "bitstamp", "solusd"),
    ("SOL-USD", "bitfinex", "tSOLUSD"),
    ("BNB-USDT", "binance", "BNBUSDT"),
    ("BNB-USDT", "bybit", "BNBUSDT"),
    ("XRP-USDT", "binance", "XRPUSDT"),
    ("XRP-USDT", "bybit", "XRPUSDT"),
    ("XRP-USD", "coinbase", "XRP-USD"),
    ("ADA-USDT", "binance", "ADAUSDT"),
    ("ADA-USDT", "bybit", "ADAUSDT"),
    ("DOGE-USDT", "binance", "DOGEUSDT"),
    ("DOGE-USDT", "bybit", "DOGEUSDT"),
    ("AVAX-USDT", "binance", "AVAXUSDT"),
    ("AVAX-USDT", "bybit", "AVAXUSDT"),
    ("LINK-USDT", "binance", "LINKUSDT"),
    ("LINK-USDT", "bybit", "LINKUSDT"),
    ("MATIC-USDT", "binance", "MATICUSDT"),
    ("MATIC-USDT", "bybit", "MATICUSDT"),
    ("DOT-USDT", "binance", "DOTUSDT"),
    ("DOT-USDT", "bybit", "DOTUSDT"),
    ("LTC-USDT", "binance", "LTCUSDT"),
    ("LTC-USDT", "bybit", "LTCUSDT"),
    ("TRX-USDT", "binance", "TRXUSDT"),
    ("TRX-USDT", "bybit", "TRXUSDT"),
    ("NEAR-USDT", "binance", "NEARUSDT"),
    ("NEAR-USDT", "bybit", "NEARUSDT"),
    ("ATOM-USDT", "binance", "ATOMUSDT"),
    ("ATOM-USDT", "bybit", "ATOMUSDT"),
    ("ARB-USDT", "binance", "ARBUSDT"),
    ("ARB-USDT", "bybit", "ARBUSDT"),
    ("OP-USDT", "binance", "OPUSDT"),
    ("OP-USDT", "bybit", "OPUSDT"),
    ("APT-USDT", "binance", "APTUSDT"),
    ("APT-USDT", "bybit", "APTUSDT"),
    ("FIL-USDT", "binance", "FILUSDT"),
    ("FIL-USDT", "bybit", "FILUSDT"),
    ("ETC-USDT", "binance", "ETCUSDT"),
    ("ETC-USDT", "bybit", "ETCUSDT"),
    ("BTC-USDT-PERP", "binance_futures", "BTCUSDT"),
    ("BTC-USDT-PERP", "bybit", "BTCUSDT"),
    ("ETH-USDT-PERP", "binance_futures", "ETHUSDT"),
    ("ETH-USDT-PERP", "bybit", "ETHUSDT"),
    ("SOL-USDT-PERP", "binance_futures", "SOLUSDT"),
    ("SOL-USDT-PERP", "bybit", "SOLUSDT"),
    ("BNB-USDT-PERP", "binance_futures", "BNBUSDT"),
    ("BNB-USDT-PERP", "bybit", "BNBUSDT"),
    ("XRP-USDT-PERP", "binance_futures", "XRPUSDT"),
    ("XRP-USDT-PERP", "bybit", "XRPUSDT"),
)
# Mask bit of each venue.
MASK = {"binance": 1, "binance_futures": 2, "bitfinex": 4, "bitstamp": 8, "bybit": 16, "coinbase": 32, "gemini": 64,
        "kraken": 128, "okx": 256}


def oracles() -> dict[str, str]:
    out = {}
    trade_cols = "ts_ns, recv_ns, symbol, venue, price, size, side, trade_id, ingested_at_ns"
    out["sink_roundtrip"] = sql(f"SELECT {trade_cols}, {date_of('ts_ns')} AS date FROM fx_trades", "fx_trades")
    out["compact_rows"] = sql(
        f"""SELECT symbol, venue, {date_of('ts_ns')} AS date, count(*) AS n,
            CAST(sum(ts_ns % 1000000007) AS BIGINT) AS sum_ts, count(trade_id) AS n_ids, 1 AS n_files
            FROM fx_trades GROUP BY 1, 2, 3""", "fx_trades")
    out["ref_landing"] = sql(
        f"""SELECT ts_ns, symbol, venue, '1m' AS interval, {rounded('open high low close volume')},
            CAST(trades AS INTEGER) AS trades, CAST(NULL AS BIGINT) AS ingested_at_ns, {date_of('ts_ns')} AS date
            FROM ({resampled('vbars', grid(60 * S))}) x""", "vbars")
    values = ", ".join(f"('{c}', '{v}', '{n}')" for c, v, n in LISTED)
    cte("listing", f"SELECT * FROM (VALUES {values}) l(canonical, venue, native)")
    out["list_symbols"] = sql("SELECT canonical, count(*) AS n_trades FROM fx_listed WHERE canonical IN "
                              "(SELECT canonical FROM listing) GROUP BY 1", "fx_listed", "listing")
    out["symbols_for_venue"] = sql("SELECT f.canonical, f.venue, l.native, count(*) AS n_trades FROM fx_listed f "
                                   "JOIN listing l USING (canonical, venue) GROUP BY 1, 2, 3", "fx_listed", "listing")
    out["perp_spot_split"] = sql("SELECT CASE WHEN canonical LIKE '%-PERP' THEN 'perp' ELSE 'spot' END AS asset_class,"
                                 " count(DISTINCT canonical) AS symbols, count(*) AS n_trades FROM fx_listed GROUP BY 1",
                                 "fx_listed")
    out["venues_listing"] = sql("SELECT canonical, array_to_string(list_sort(list(DISTINCT venue)), ',') AS venues "
                                "FROM listing WHERE canonical IN (SELECT canonical FROM fx_listed) GROUP BY 1",
                                "fx_listed", "listing")
    out["symbol_attrs"] = sql(
        "SELECT DISTINCT canonical, CASE WHEN canonical LIKE '%-PERP' THEN 'perp' ELSE 'spot' END AS asset_class, "
        "split_part(canonical, '-', 1) AS base, split_part(canonical, '-', 2) AS quote FROM fx_listed", "fx_listed")
    t = T0 + 200 * S
    out["symbol_map_asof"] = sql(f"SELECT * FROM fx_symbol_map WHERE effective_from_ns <= {t} AND "
                                 f"(effective_to_ns IS NULL OR effective_to_ns > {t})", "fx_symbol_map")
    out["symbol_map_asof_many"] = sql(
        f"SELECT i.ts_ns, m.* FROM (SELECT DISTINCT ts_ns - ts_ns % {10 * S} AS ts_ns FROM fx_trades) i JOIN fx_symbol_map m "
        "ON effective_from_ns <= i.ts_ns AND (effective_to_ns IS NULL OR effective_to_ns > i.ts_ns)", "fx_trades", "fx_symbol_map")
    out["symbol_map_seed"] = sql("SELECT * FROM fx_symbol_map", "fx_symbol_map")
    hit = "canonical = 'BTC-USDT' AND venue = 'binance' AND effective_to_ns IS NULL"
    out["symbol_map_retire"] = sql(
        f"SELECT * REPLACE (CASE WHEN {hit} THEN {T0 + 900 * S} ELSE effective_to_ns END AS effective_to_ns, "
        f"CASE WHEN {hit} THEN 'delisted' ELSE note END AS note) FROM fx_symbol_map", "fx_symbol_map")
    out["corrections_list"] = sql("SELECT * FROM fx_corrections WHERE table_name = 'trades' AND venue = 'okx' AND "
                                  f"recorded_at_ns >= {T0 + 120 * S}", "fx_corrections")
    rest = ("effective_from_ns, effective_to_ns, table_name, symbol, venue, kind, severity, rows_affected, note")
    out["corrections_append"] = sql(
        f"SELECT {rest} FROM fx_corrections WHERE kind IN ('backfill', 'restatement', 'bad_range', 'gap', 'note') AND "
        f"severity IN ('info', 'minor', 'major', 'critical') UNION ALL SELECT {T0 + 900 * S}, {T0 + 900 * S}, 'symbol_map', "
        "'BTC-USDT', 'binance', 'restatement', 'info', NULL, 'BTC-USDT at binance retired (delisted)'", "fx_corrections")
    place = f"(ts_ns + CASE WHEN ts_ns // {S} % 7 = 3 THEN {5 * S + 1} ELSE 0 END)"
    shaken = f"CASE WHEN seq % 9 = 0 THEN ts_ns - {3 * S} ELSE ts_ns END"
    cte("damaged", f"SELECT symbol, venue, {date_of('t')} AS date, t, seq AS place, 'trade' AS kind FROM "
                   f"(SELECT *, {shaken} AS t FROM fx_trades) x UNION ALL "
                   f"SELECT symbol, venue, date, ts_ns, {place}, 'bar' FROM bars", "fx_trades", "bars")
    cte("steps", f"SELECT *, lag(t) OVER (PARTITION BY kind, {SL} ORDER BY place, t) AS before FROM damaged", "damaged")
    out["dq_order"] = sql(
        f"SELECT {SL}, kind || '.timestamps_out_of_order' AS check, CASE kind WHEN 'bar' THEN 'major' ELSE 'minor' END AS "
        f"severity, count(*) AS count FROM steps WHERE t < before GROUP BY {SL}, kind", "steps")
    out["quality_json"] = sql(f"SELECT symbol, venue, count(*) AS bars, CAST(date AS VARCHAR) AS date FROM bars "
                              f"GROUP BY {SL}", "bars")
    out["corrections_rollup"] = sql("SELECT kind, severity, count(*) AS n FROM fx_corrections GROUP BY 1, 2",
                                    "fx_corrections")
    out["quality_upsert"] = sql(
        f"SELECT {SL}, count(*) + CASE WHEN venue = 'agg' THEN 1 ELSE 0 END AS bars, "
        f"CASE WHEN venue = 'agg' THEN 2 ELSE 1 END AS version FROM bars GROUP BY {SL}", "bars")
    now = T0 + 420 * S
    cte("rates", f"""SELECT venue, symbol, 'trades' AS stream,
        count(*) FILTER (recv_ns >= {now - 300 * S}) / 300.0::DOUBLE AS recent_per_s,
        count(*) FILTER (recv_ns >= {now - 3600 * S}) / 3600.0::DOUBLE AS baseline_per_s
        FROM fx_trades WHERE recv_ns <= {now} GROUP BY 1, 2""", "fx_trades")
    two = f"{r('recent_per_s', 8)} AS recent_per_s, {r('baseline_per_s', 8)} AS baseline_per_s"
    up = "(baseline_per_s = 0 OR recent_per_s >= 0.1 * baseline_per_s) AS up"
    out["feed_health"] = sql(f"SELECT venue, symbol, stream, {two}, {up} FROM rates", "rates")
    cte("steps", """SELECT recv_ns - recv_ns % 60000000000 + 60000000000 AS ts_ns, venue, symbol,
        'trades' AS stream, count(*) AS n FROM fx_trades GROUP BY 1, 2, 3""", "fx_trades")
    cte("series", f"""SELECT a.ts_ns, a.venue, a.symbol, a.stream, any_value(a.n) AS n,
        CAST(sum(b.n) FILTER (b.ts_ns > a.ts_ns - {300 * S}) AS DOUBLE) / 300 AS recent_per_s,
        CAST(sum(b.n) AS DOUBLE) / 3600 AS baseline_per_s
        FROM steps a JOIN steps b ON a.venue = b.venue AND a.symbol = b.symbol AND b.ts_ns <= a.ts_ns
             AND b.ts_ns > a.ts_ns - {3600 * S} GROUP BY 1, 2, 3, 4""", "steps")
    out["feed_health_series"] = sql(f"SELECT ts_ns, venue, symbol, stream, n, {two}, {up} FROM series", "series")
    out["health_latest"] = sql("SELECT venue, stream, symbol, up, ts_ns FROM fx_status WHERE ts_ns = "
                               "(SELECT max(ts_ns) FROM fx_status)", "fx_status")
    end, start = T0 + 450 * S, T0 + 450 * S - 7200 * S
    out["gap_worklist"] = sql(
        f"""SELECT l.venue, l.symbol, coalesce(m.last_seen, {start}) + 1 AS fetch_from_ns, {end} AS fetch_to_ns
            FROM (SELECT venue, symbol FROM fx_trades UNION SELECT venue, canonical FROM fx_listed) l
            LEFT JOIN (SELECT venue, symbol, max(ts_ns) AS last_seen FROM fx_trades
                       WHERE (venue <> 'okx' OR ts_ns < {T0 + 100 * S}) AND ts_ns BETWEEN {start} AND {end}
                       GROUP BY 1, 2) m USING (venue, symbol)
            WHERE {end} - coalesce(m.last_seen, {start}) >= {60 * S}""", "fx_trades", "fx_listed")
    parts = []
    for name, src, day in (("trades", "fx_trades", "date"), ("quotes", "fx_quotes", "date"),
                           ("funding", "fx_funding", date_of("ts_ns")), ("open_interest", "fx_oi", date_of("ts_ns")),
                           ("book_l2_snapshot", "fx_books", date_of("ts_ns")), ("bars_1s", "bars", "date")):
        parts.append(f"SELECT '{name}' AS table_name, symbol, venue, {day} AS date, count(*) AS rows, "
                     f"min(ts_ns) AS first_ts_ns, max(ts_ns) AS last_ts_ns, "
                     f"(max(ts_ns) - min(ts_ns)) // 1000000000 AS span_seconds FROM {src} GROUP BY 1, 2, 3, 4")
    cte("cover", " UNION ALL ".join(parts), "fx_trades", "fx_quotes", "fx_funding", "fx_oi", "fx_books", "bars")
    out["coverage"] = sql("SELECT * FROM cover", "cover")
    out["coverage_by_table"] = sql(
        "SELECT table_name, count(*) AS partitions, CAST(sum(rows) AS BIGINT) AS rows, count(DISTINCT symbol) AS "
        "symbols, count(DISTINCT venue) AS venues, min(date) AS first_date, max(date) AS last_date FROM cover "
        "GROUP BY 1", "cover")
    pivot = ", ".join(f"CAST(sum(rows) FILTER (venue = '{v}') AS BIGINT) AS {v}"
                      for v in ("agg", "binance", "bybit", "coinbase", "kraken", "okx"))
    out["coverage_matrix"] = sql(f"SELECT table_name, symbol, {pivot} FROM cover GROUP BY 1, 2", "cover")
    lists = ", ".join(f"array_to_string(list_sort(list(DISTINCT {c})), ',') AS {c}s" for c in ("symbol", "venue", "date"))
    out["coverage_summary"] = sql(f"SELECT count(*) AS partitions, CAST(sum(rows) AS BIGINT) AS total_rows, {lists} "
                                  "FROM cover", "cover")
    out["bars_span"] = sql("SELECT min(ts_ns) AS lo, max(ts_ns) AS hi, count(*) AS n FROM bars", "bars")
    out["pipeline_manifest"] = sql(
        "SELECT table_name, CAST(sum(rows) AS BIGINT) AS rows, count(DISTINCT symbol) AS symbols, count(DISTINCT "
        "venue) AS venues, min(date) AS first_date, max(date) AS last_date FROM cover "
        "WHERE table_name IN ('trades', 'quotes', 'bars_1s') GROUP BY 1", "cover")
    out["coverage_footers"] = sql("SELECT *, TRUE AS bytes_on_disk FROM cover WHERE table_name IN ('trades', 'quotes')", "cover")
    out["manifest_text"] = sql(
        "SELECT 1::BIGINT AS run, (SELECT count(*) FROM bars WHERE venue <> 'agg') AS per_venue_1s, "
        "(SELECT count(*) FROM bars WHERE venue = 'agg') AS agg_1s, (SELECT count(DISTINCT (symbol, date)) FROM bars) AS slices, "
        "count(*) AS partitions, CAST(sum(rows) AS BIGINT) AS total_rows, TRUE AS has_bytes, "
        "(SELECT count(DISTINCT (symbol, venue, date)) FROM bars) AS cards "
        "FROM cover WHERE table_name IN ('trades', 'bars_1s')", "cover", "bars")
    wide = ", ".join(f"{r(f'max(close) FILTER (venue = {chr(39)}{v}{chr(39)})')} AS {v}"
                     for v in ("agg", "binance", "bybit", "coinbase", "kraken", "okx"))
    out["wide_closes"] = sql(f"SELECT ts_ns, symbol, {wide} FROM bars GROUP BY 1, 2", "bars")
    cte("te", """SELECT v.ts_ns, v.symbol, v.venue, (v.close - t.close) / t.close * 1e4 AS te_bps FROM bars v
        JOIN tape t ON t.ts_ns = v.ts_ns AND t.symbol = v.symbol WHERE v.venue <> 'agg'""", "bars", "tape")
    out["tracking_error"] = sql(f"SELECT ts_ns, symbol, venue, {r('te_bps')} AS te_bps FROM te", "te")
    stats = {"mean": "avg(te_bps)", "std": "stddev_samp(te_bps)", "min": "min(te_bps)", "max": "max(te_bps)",
             "q25": "quantile_cont(te_bps, 0.25)", "q50": "quantile_cont(te_bps, 0.5)",
             "q75": "quantile_cont(te_bps, 0.75)"}
    out["tracking_error_stats"] = sql(
        "SELECT symbol, venue, count(*) AS count, " + ", ".join(f"{r(e)} AS {n}" for n, e in stats.items())
        + " FROM te GROUP BY 1, 2", "te")
    out["dispersion"] = sql(f"SELECT ts_ns, symbol, {r('(max(close) - min(close)) / ((max(close) + min(close)) / 2) * 1e4')} "
                            "AS disp_bps FROM vbars GROUP BY 1, 2", "vbars")
    cte("shares", " UNION ALL ".join(
        f"SELECT symbol, '{v}' AS venue, avg(CASE WHEN sources_mask & {b} <> 0 THEN 1 ELSE 0 END) * 100 AS share_pct "
        "FROM tape GROUP BY 1" for v, b in MASK.items()), "tape")
    out["mask_presence"] = sql(f"SELECT symbol, venue, {r('share_pct', 4)} AS share_pct FROM shares "
                               "WHERE share_pct > 0", "shares")
    out["mask_histogram"] = sql("SELECT symbol, CAST(bit_count(sources_mask) AS INTEGER) AS n_venues, count(*) AS "
                                "seconds FROM tape GROUP BY 1, 2", "tape")
    out["filter_anatomy"] = sql(
        f"SELECT symbol, CAST(sum(n_raw) AS BIGINT) AS n_raw, CAST(sum(n_dropped) AS BIGINT) AS n_dropped, "
        f"{r('sum(n_dropped) * 100.0 / greatest(sum(n_raw), 1)')} AS dropped_pct, "
        "count(*) FILTER (n_dropped > 0) AS fired_seconds FROM tape_all GROUP BY 1", "tape_all")
    out["tape_breaches"] = sql(
        """SELECT t.symbol, count(*) AS seconds, count(*) FILTER (t.close < lo - 1e-6 OR t.close > hi + 1e-6)
           AS breaches FROM tape t JOIN (SELECT ts_ns, symbol, min(close) AS lo, max(close) AS hi FROM vbars
           WHERE venue <> 'bybit' GROUP BY 1, 2) e ON e.ts_ns = t.ts_ns AND e.symbol = t.symbol GROUP BY 1""",
        "tape", "vbars")
    return out
