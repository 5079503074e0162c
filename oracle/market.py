"""Oracle texts for tape, bars, resampling, query functions, checks and books."""

from __future__ import annotations

from oracle.base import BAR_COLS, VENUE_BARS, cte, date_of, r, rounded, sql

OHLC = "open high low close volume vwap"
T0 = 1700006200000000000
BARS_OUT = f"ts_ns, symbol, venue, {rounded(OHLC)}, trades, sources_mask, ingested_at_ns"


def resampled(src: str, bucket: str, where: str = "TRUE", mask: str = "max(sources_mask)") -> str:
    return (f"SELECT {bucket} AS ts_ns, symbol, venue, first(open ORDER BY ts_ns) AS open, max(high) AS high, "
            f"min(low) AS low, last(close ORDER BY ts_ns) AS close, sum(volume) AS volume, "
            f"CASE WHEN sum(volume) > 0 THEN sum(vwap * volume) / sum(volume) "
            f"ELSE last(close ORDER BY ts_ns) END AS vwap, CAST(sum(trades) AS BIGINT) AS trades, "
            f"{mask} AS sources_mask, max(ingested_at_ns) AS ingested_at_ns "
            f"FROM {src} WHERE {where} GROUP BY {bucket}, symbol, venue")


def grid(step: int, origin: int = 0) -> str:
    return f"(ts_ns - (ts_ns - {origin}) % {step})"


S = 1_000_000_000
STEPS = {"5s": 5 * S, "1m": 60 * S, "15m": 900 * S, "4h": 14400 * S, "1d": 86400 * S}


def window(lo_s: int, hi_s: int) -> str:
    return f"ts_ns >= {T0 + lo_s * S} AND ts_ns < {T0 + hi_s * S}"


def from_start() -> str:
    return f"ts_ns >= {T0}"


def ts_text(expr: str = "ts_ns") -> str:
    return f"strftime(make_timestamp({expr} // 1000), '%Y-%m-%d %H:%M:%S.%f')"


def tape_oracles() -> dict[str, str]:
    out = {
        "tape_1s": sql(f"SELECT {BARS_OUT} FROM tape", "tape"),
        "tape_diag": sql(f"SELECT ts_ns, symbol, n_raw, n_kept, n_dropped, {r('median_px')} AS median_px, "
                         "array_to_string(venues, ',') AS venues FROM tape_all", "tape_all"),
        "tape_mask": sql("SELECT symbol, sources_mask, count(*) AS n, bit_count(sources_mask)::INTEGER AS n_venues "
                         "FROM tape GROUP BY 1, 2", "tape"),
        "tape_gates": sql("SELECT symbol, venue, count(*) AS n FROM fx_trades WHERE venue <> 'kraken' AND size > 0 "
                          "AND recv_ns - ts_ns <= 5000000000 GROUP BY 1, 2", "fx_trades"),
        "tape_filter_diag": sql("SELECT symbol, count(*) AS fired_seconds, CAST(sum(n_dropped) AS BIGINT) AS dropped "
                                "FROM tape_all WHERE n_dropped > 0 GROUP BY 1", "tape_all"),
        "tape_run_summary": sql(
            "SELECT s.symbol, consolidated_trades, contributing_venues, agg_bars, trades_dropped_by_filter FROM "
            "(SELECT symbol, count(*) AS consolidated_trades, array_to_string(list_sort(list(DISTINCT venue)), ',') "
            "AS contributing_venues FROM fx_trades WHERE venue <> 'bybit' GROUP BY 1) s LEFT JOIN "
            "(SELECT symbol, count(*) FILTER (n_kept > 0) AS agg_bars, CAST(sum(n_dropped) AS BIGINT) AS "
            "trades_dropped_by_filter FROM tape_all GROUP BY 1) d USING (symbol)", "tape_all"),
        "merged_tape": sql("SELECT symbol, ts_ns, recv_ns, venue, seq, price, size FROM fx_trades "
                           "WHERE venue <> 'bybit'", "fx_trades"),
        "bars_1s_venue": sql(f"SELECT {BARS_OUT} FROM vbars", "vbars"),
        "entry_tape_1m": sql(f"SELECT {BARS_OUT} FROM ({resampled('tape', grid(STEPS['1m']))}) x", "tape"),
    }
    cte("blend_kept", """SELECT v.* FROM (SELECT *, count(*) OVER w AS n, median(close) OVER w AS med,
        FROM vbars WHERE volume > 0 WINDOW w AS (PARTITION BY symbol, ts_ns)) v JOIN
        (SELECT symbol, ts_ns, median(abs(close - med)) AS mad FROM (SELECT symbol, ts_ns, close,
             median(close) OVER (PARTITION BY symbol, ts_ns) AS med FROM vbars WHERE volume > 0) z GROUP BY 1, 2) m
        USING (symbol, ts_ns)
        WHERE n < 3 OR (mad > 0 AND abs(close - med) <= 5.0 * (mad * 1.4826))
           OR (mad <= 0 AND abs(close - med) <= greatest(med * 1e-3, 1e-12))""", "vbars")
    from oracle.base import BIT
    out["agg_second"] = sql(
        "SELECT ts_ns, symbol, 'agg' AS venue, "
        f"{r('sum(open * volume) / sum(volume)')} AS open, {r('max(high)')} AS high, {r('min(low)')} AS low, "
        f"{r('sum(close * volume) / sum(volume)')} AS close, {r('sum(volume)')} AS volume, "
        f"{r('sum(vwap * volume) / sum(volume)')} AS vwap, CAST(sum(trades) AS INTEGER) AS trades, "
        f"CAST(bit_or({BIT}) AS INTEGER) AS sources_mask FROM blend_kept GROUP BY ts_ns, symbol", "blend_kept")
    cte("status_iv", """SELECT venue, symbol, ts_ns AS f, lead(ts_ns) OVER (PARTITION BY venue, symbol
        ORDER BY ts_ns) AS t, up FROM fx_status""", "fx_status")
    from oracle.base import TAPE
    cte("healthy", """SELECT * FROM fx_trades x WHERE NOT EXISTS (SELECT 1 FROM status_iv s WHERE NOT up
        AND s.venue = x.venue AND s.symbol = x.symbol AND x.ts_ns >= s.f AND (s.t IS NULL OR x.ts_ns < s.t))""",
        "fx_trades", "status_iv")
    hot = "seq % 3 = 0"
    cte("hot_second", f"SELECT * REPLACE (CASE WHEN {hot} THEN {T0} ELSE ts_ns END AS ts_ns, CASE WHEN {hot} THEN {T0} ELSE recv_ns "
        f"END AS recv_ns, CASE WHEN {hot} THEN price + seq / 1e7 ELSE price END AS price) FROM fx_trades", "fx_trades")
    cte("tape_hot", TAPE.replace("{src}", "hot_second").replace("{bit}", BIT), "hot_second")
    out["tape_hot_second"] = sql(
        f"SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in (OHLC + ' median_px').split())}, "
        "array_to_string(venues, ',') AS venues) FROM tape_hot", "tape_hot")
    cte("tape_healthy", TAPE.replace("{src}", "healthy").replace("{bit}", BIT), "healthy")
    out["tape_health_excluded"] = sql(f"SELECT {BARS_OUT} FROM tape_healthy WHERE n_kept > 0", "tape_healthy")
    return out


def bar_oracles() -> dict[str, str]:
    out = {}
    for name, step in STEPS.items():
        out[f"resample_{name}"] = sql(f"SELECT {BARS_OUT} FROM ({resampled('bars', grid(step))}) x", "bars")
    out["resample_1w"] = sql(
        f"SELECT {BARS_OUT} FROM ({resampled('bars', grid(7 * 86400 * S, 3 * 86400 * S))}) x", "bars")
    cte("anchored", "SELECT b.*, a.anchor FROM bars b JOIN (SELECT symbol, venue, "
                    f"min(ts_ns) - min(ts_ns) % {86400 * S} AS anchor FROM bars GROUP BY 1, 2) a USING (symbol, venue)",
        "bars")
    out["resample_7h"] = sql(
        f"SELECT {BARS_OUT} FROM ({resampled('anchored', f'(ts_ns - (ts_ns - anchor) % {7 * 3600 * S})')}) x",
        "anchored")
    out["resample_mask_or"] = sql(
        "SELECT ts_ns, symbol, venue, sources_mask FROM ("
        + resampled("bars", grid(60 * S), mask="CAST(bit_or(sources_mask) AS INTEGER)") + ") x", "bars")
    agg = "venue = 'agg'"
    out["get_bars_1s"] = sql(f"SELECT {BARS_OUT}, {ts_text()} AS ts FROM bars WHERE {agg} AND {window(10, 4000)}",
                             "bars")
    for name, step in {"1m": 60 * S, "5m": 300 * S, "1h": 3600 * S, "1d": 86400 * S}.items():
        out[f"get_bars_{name}"] = sql(
            f"SELECT {BARS_OUT}, {ts_text()} AS ts FROM "
            f"({resampled('bars', grid(step), f'{agg} AND {window(10, 4000)}')}) x", "bars")
    two = "venue IN ('binance', 'coinbase')"
    five = grid(300 * S)
    out["get_bars_multi"] = sql(f"SELECT {BARS_OUT}, {ts_text()} AS ts FROM "
                                f"({resampled('bars', five, f'{two} AND {from_start()}')}) x", "bars")
    cut = T0 + 310 * S
    out["bars_asof"] = sql(
        f"SELECT {BARS_OUT}, {ts_text()} AS ts FROM "
        f"({resampled('bars', grid(60 * S), f'{agg} AND {from_start()} AND ingested_at_ns <= {cut}')}) x", "bars")
    out["bars_fields"] = sql(
        f"SELECT {r('close')} AS close, {r('volume')} AS volume, venue FROM "
        f"({resampled('bars', five, f'{two} AND {from_start()}')}) x", "bars")
    out["bars_tz"] = sql(
        "SELECT symbol, strftime(make_timestamp(ts_ns // 1000) + INTERVAL 9 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS ts, "
        f"{r('close')} AS close FROM ({resampled('bars', five, f'{agg} AND {from_start()}')}) x", "bars")
    nulled = f"SELECT * REPLACE (CAST(NULL AS BIGINT) AS ingested_at_ns) FROM bars WHERE {agg}"
    cte("bars_no_ingest", nulled, "bars")
    out["bars_fill_zero"] = sql(
        f"SELECT ts_ns, symbol, venue, {rounded(OHLC)}, trades, sources_mask, "
        "coalesce(ingested_at_ns, 0) AS ingested_at_ns FROM "
        f"({resampled('bars_no_ingest', five, from_start())}) x", "bars_no_ingest")
    cte("m5s", resampled("bars", grid(5 * S)), "bars")
    cte("m5s_next", "SELECT *, lead(ts_ns) OVER (PARTITION BY symbol, venue ORDER BY ts_ns) AS nxt FROM m5s", "m5s")
    cte("grid5", f"""SELECT m.*, unnest(generate_series(ts_ns, coalesce(nxt - {5 * S}, ts_ns), {5 * S})) AS g
        FROM m5s_next m""", "m5s_next")
    flat = ", ".join(f"{r(f'CASE WHEN g = ts_ns THEN {c} ELSE close END')} AS {c}" for c in ("open", "high", "low"))
    out["bars_grid_ffill"] = sql(
        f"SELECT g AS ts_ns, symbol, venue, {flat}, {r('close')} AS close, "
        f"{r('CASE WHEN g = ts_ns THEN volume ELSE 0 END')} AS volume, "
        "CASE WHEN g = ts_ns THEN trades ELSE 0 END AS trades, g <> ts_ns AS filled FROM grid5", "grid5")
    end, seven = T0 + 200_000 * S, 7 * 3600 * S
    cte("early", f"SELECT * FROM bars WHERE ts_ns < {end}", "bars")
    cte("m7h", resampled(f"(SELECT b.*, a.anchor FROM early b JOIN (SELECT symbol, venue, min(ts_ns) - min(ts_ns) % {86400 * S} "
                         "AS anchor FROM early GROUP BY 1, 2) a USING (symbol, venue)) e",
                         f"(ts_ns - (ts_ns - anchor) % {seven})"), "early")
    cte("grid7", f"""SELECT m.*, unnest(generate_series(ts_ns, coalesce(nxt - {seven},
        ts_ns + ({end} - 1 - ts_ns) // {seven} * {seven}), {seven})) AS g FROM (SELECT *, lead(ts_ns) OVER
        (PARTITION BY symbol, venue ORDER BY ts_ns) AS nxt FROM m7h) m""", "m7h")
    out["grid_7h_end"] = sql(
        f"SELECT g AS ts_ns, symbol, venue, {flat}, {r('close')} AS close, "
        f"{r('CASE WHEN g = ts_ns THEN volume ELSE 0 END')} AS volume, "
        "CASE WHEN g = ts_ns THEN trades ELSE 0 END AS trades, g <> ts_ns AS filled FROM grid7", "grid7")
    out["bars_fill_ffill"] = sql(
        f"SELECT {BARS_OUT} FROM ({resampled('bars', five, f'{agg} AND {from_start()}')}) x", "bars")
    cte("tied", f"SELECT * REPLACE (ts_ns - ts_ns % {S} AS ts_ns) FROM fx_trades", "fx_trades")
    cte("tied_bars", VENUE_BARS.replace("{src}", "tied"), "tied")
    out["bars_from_store"] = out["bars_from_landed"] = sql(f"SELECT {BARS_OUT} FROM tied_bars", "tied_bars")
    out["bars_latest_version"] = sql(
        f"SELECT {BARS_OUT}, {ts_text()} AS ts FROM ({resampled('bars', grid(60 * S), agg)}) x", "bars")
    return out


def query_oracles() -> dict[str, str]:
    w = window(100, 2000)
    out = {
        "scan_trades": sql("SELECT symbol, venue, date, count(*) AS n, min(ts_ns) AS first_ts_ns, "
                           "max(ts_ns) AS last_ts_ns FROM fx_trades GROUP BY 1, 2, 3", "fx_trades"),
        "get_trades": sql(f"SELECT ts_ns, recv_ns, venue, price, size, side, trade_id FROM fx_trades WHERE "
                          f"symbol = 'SYM1' AND venue IN ('binance', 'okx') AND {w}", "fx_trades"),
        "get_quotes": sql(f"SELECT ts_ns, recv_ns, venue, {rounded('bid_px ask_px bid_sz ask_sz')} FROM fx_quotes "
                          f"WHERE symbol = 'SYM1' AND {w}", "fx_quotes"),
        "get_funding": sql(f"SELECT ts_ns, recv_ns, venue, {r('funding_rate', 10)} AS funding_rate, "
                           f"{r('mark_price')} AS mark_price, next_ts_ns FROM fx_funding "
                           f"WHERE symbol = 'SYM1-PERP' AND {w}", "fx_funding"),
        "funding_wide": sql(f"SELECT symbol, ts_ns, {r('max(funding_rate) FILTER (venue = ' + chr(39) + 'bybit' + chr(39) + ')', 10)} AS bybit, "
                            f"{r('max(funding_rate) FILTER (venue = ' + chr(39) + 'okx' + chr(39) + ')', 10)} AS okx "
                            "FROM fx_funding GROUP BY 1, 2", "fx_funding"),
        "get_open_interest": sql(f"SELECT ts_ns, venue, oi_base, oi_quote FROM fx_oi "
                                 f"WHERE symbol = 'SYM2-PERP' AND {w}", "fx_oi"),
        "ref_bars": sql(f"SELECT ts_ns, venue, {rounded('open high low close volume')}, trades FROM "
                        f"({resampled('vbars', grid(60 * S))}) x WHERE symbol = 'SYM0' AND {window(0, 2000)}",
                        "vbars"),
        "book_snapshots": sql(
            "SELECT ts_ns, recv_ns, venue, depth, len(bids[1:2]) AS n_bids, "
            f"{r('bids[1:2][-1].px')} AS last_bid_px, {r('asks[1:2][-1].px')} AS last_ask_px, "
            f"{r('bids[1:2][-1].sz')} AS last_bid_sz FROM fx_books WHERE symbol = 'SYM0' AND venue = 'okx' "
            f"AND {w}", "fx_books"),
        "book_symbols": sql("SELECT DISTINCT symbol, venue FROM fx_books", "fx_books"),
        "venue_status": sql(f"SELECT ts_ns, venue, symbol, stream, up, coverage_pct, notes FROM fx_status "
                            f"WHERE ts_ns >= {T0 + 100 * S}", "fx_status"),
        "slices_present": sql("SELECT DISTINCT symbol, date FROM fx_trades", "fx_trades"),
        "part_date": sql(f"SELECT {date_of('ts_ns')} AS day, count(*) AS n FROM fx_trades GROUP BY 1", "fx_trades"),
        "hour_bucket": sql("SELECT symbol, venue, ts_ns // 3600000000000 AS hour, count(*) AS n FROM fx_trades "
                           "GROUP BY 1, 2, 3", "fx_trades"),
        "sql_adhoc": sql("SELECT venue, count(*) AS n, min(ts_ns) AS lo, max(ts_ns) AS hi FROM bars "
                         "WHERE symbol = 'SYM0' GROUP BY venue", "bars"),
        "top_series": sql("SELECT symbol, venue, count(*) AS n, min(ts_ns) AS lo, max(ts_ns) AS hi FROM bars "
                          "GROUP BY 1, 2 ORDER BY n DESC, symbol, venue LIMIT 1", "bars"),
        "scan_empty": "SELECT 'quotes' AS table_name, 0::BIGINT AS n, count(*) AS n_events FROM events",
    }
    out["book_top"] = sql(
        "SELECT ts_ns, symbol, venue, "
        + ", ".join(f"{r(e)} AS {n}" for n, e in {
            "bid_px": "bids[1].px", "bid_sz": "bids[1].sz", "ask_px": "asks[1].px", "ask_sz": "asks[1].sz",
            "mid": "(bids[1].px + asks[1].px) / 2",
            "spread_bps": "(asks[1].px - bids[1].px) / ((bids[1].px + asks[1].px) / 2) * 1e4",
            "imbalance": "(bids[1].sz - asks[1].sz) / (bids[1].sz + asks[1].sz)"}.items())
        + " FROM fx_books", "fx_books")
    cte("bq", """SELECT symbol, venue, count(*) AS n_snapshots,
        count(*) FILTER (len(bids) = 0 OR len(asks) = 0) AS empty_side,
        count(*) FILTER (len(bids) > 0 AND len(asks) > 0 AND bids[1].px >= asks[1].px) AS crossed_top,
        count(*) FILTER (len(asks) > 0 AND (bids[1].px < bids[2].px OR bids[2].px < bids[3].px)) AS bids_not_descending,
        count(*) FILTER (asks[1].px > asks[2].px OR asks[2].px > asks[3].px) AS asks_not_ascending,
        count(*) FILTER (len(asks) > 0 AND (len(list_filter(bids, lambda x: x.px <= 0 OR x.sz < 0)) > 0
                      OR len(list_filter(asks, lambda x: x.px <= 0 OR x.sz < 0)) > 0)) AS nonpositive_level,
        count(*) FILTER (len(bids) > 0 AND len(asks) > 0 AND
             (len(list_distinct(list_transform(bids, lambda x: x.px))) < len(bids)
              OR len(list_distinct(list_transform(asks, lambda x: x.px))) < len(asks))) AS duplicate_price_level
        FROM bk GROUP BY 1, 2""", "bk")
    # damaged books: every 7th loses its asks, every 11th has its bids reversed, every 13th repeats a level
    cte("bk", """SELECT symbol, venue,
        CASE WHEN seq % 11 = 0 THEN list_reverse(bids) WHEN seq % 13 = 0 THEN [bids[1], bids[1], bids[3]]
             ELSE bids END AS bids,
        CASE WHEN seq % 7 = 0 THEN [] ELSE asks END AS asks FROM fx_books""", "fx_books")
    out["book_quality"] = sql(
        "SELECT *, " + r("100.0 * (1 - (empty_side + crossed_top + bids_not_descending + asks_not_ascending + "
                         "nonpositive_level + duplicate_price_level) / n_snapshots)", 2)
        + " AS clean_pct FROM bq", "bq")
    return out


def quality_oracles() -> dict[str, str]:
    out = {}
    sl = "symbol, venue, date"
    # bars with faults planted by row: the same text runs on both sides
    cte("bad_bars", f"SELECT {BAR_COLS}, date FROM bars", "bars")

    def issues(stats: str, checks: list[tuple[str, str, str]], *needs: str) -> str:
        parts = [f"SELECT {sl}, '{c}' AS \"check\", {sev if sev.startswith('CASE') else repr(sev)} AS severity, "
                 f"CAST({n} AS BIGINT) AS \"count\" FROM st WHERE {n} > 0" for c, sev, n in checks]
        cte("st", stats, *needs)
        text = sql(" UNION ALL ".join(parts), "st")
        return text

    out["dq_bar_ohlc"] = issues(
        f"""SELECT {sl}, count(*) FILTER (h < greatest(open, close) - 1e-9) AS hi,
            count(*) FILTER (low > least(open, close) + 1e-9) AS lo, count(*) FILTER (h < low - 1e-9) AS hl,
            count(*) FILTER (v < 0) AS vol, count(*) FILTER (vwap < low - 1e-6 OR vwap > h + 1e-6) AS vw,
            count(*) FILTER (least(open, h, low, close) <= 0) AS px
            FROM (SELECT *, CASE WHEN (ts_ns // 1000000000) % 50 = 7 THEN low - 1 ELSE high END AS h,
                  CASE WHEN (ts_ns // 1000000000) % 70 = 3 THEN -volume - 1 ELSE volume END AS v FROM bars) b
            GROUP BY 1, 2, 3""",
        [("bar.high_below_body", "major", "hi"), ("bar.low_above_body", "major", "lo"),
         ("bar.high_below_low", "critical", "hl"), ("bar.negative_volume", "critical", "vol"),
         ("bar.vwap_outside_hl", "major", "vw"), ("bar.nonpositive_price", "critical", "px")], "bars")
    out["dq_bar_ts"] = issues(
        f"""SELECT {sl}, count(*) - count(DISTINCT t) AS dup, count(*) FILTER (t % 1000000000 <> 0) AS off
            FROM (SELECT {sl}, CASE WHEN (ts_ns // 1000000000) % 40 = 5 THEN ts_ns + 1000000
                  WHEN (ts_ns // 1000000000) % 40 = 6 THEN ts_ns - 1000000000 ELSE ts_ns END AS t FROM bars) b
            GROUP BY 1, 2, 3 HAVING count(*) >= 2""",
        [("bar.duplicate_timestamps", "major", "dup"), ("bar.timestamp_off_second_grid", "minor", "off")], "bars")
    # 100 s and 700 s holes cut into the bars so that gaps fire
    cte("gappy", f"SELECT * FROM bars WHERE (ts_ns // 1000000000) % 400 < 300", "bars")
    cte("gaps", f"""SELECT {sl}, ts_ns, close, (ts_ns - lag(ts_ns) OVER w) / 1e9 AS gap_s,
        lag(close) OVER w AS prev_close FROM gappy WINDOW w AS (PARTITION BY {sl} ORDER BY ts_ns)""", "gappy")
    out["bar_diffs"] = sql(f"SELECT {sl}, ts_ns, {r('gap_s')} AS gap_s FROM gaps", "gaps")
    cte("gap_th", f"""SELECT {sl}, greatest(60.0, 30.0 * median(gap_s)) AS warn,
        greatest(600.0, 120.0 * median(gap_s)) AS major FROM gaps WHERE gap_s IS NOT NULL GROUP BY 1, 2, 3""", "gaps")
    cte("gap_rows", f"""SELECT g.*, warn, major, row_number() OVER (PARTITION BY {sl} ORDER BY gap_s DESC) AS rk
        FROM gaps g JOIN gap_th USING ({sl}) WHERE gap_s IS NOT NULL""", "gaps", "gap_th")
    out["dq_bar_gaps"] = sql(
        f"""SELECT {sl}, 'bar.gaps' AS "check",
            CASE WHEN count(*) FILTER (gap_s > 1.5 AND gap_s >= major) > 0 THEN 'major' ELSE 'minor' END AS severity,
            count(*) FILTER (gap_s > 1.5 AND gap_s >= warn) AS "count",
            array_to_string(list(CAST(CAST(gap_s AS BIGINT) AS VARCHAR) ORDER BY gap_s DESC)
                            FILTER (gap_s > 1.5 AND rk <= 5), ',') AS top
            FROM gap_rows GROUP BY 1, 2, 3 HAVING count(*) FILTER (gap_s > 1.5 AND gap_s >= warn) > 0""", "gap_rows")
    cte("runs", f"""SELECT {sl}, run, count(*) AS len FROM (SELECT *, sum(CASE WHEN prev IS NULL OR c <> prev
        THEN 1 ELSE 0 END) OVER (PARTITION BY {sl} ORDER BY ts_ns ROWS UNBOUNDED PRECEDING) AS run
        FROM (SELECT {sl}, ts_ns, c, lag(c) OVER (PARTITION BY {sl} ORDER BY ts_ns) AS prev
              FROM (SELECT {sl}, ts_ns, round(close, 0) AS c FROM bars) a) b) d GROUP BY {sl}, run""", "bars")
    out["flatline"] = sql(f"SELECT {sl}, CAST(sum(len) AS BIGINT) AS bars, max(len) AS longest FROM runs "
                          "GROUP BY 1, 2, 3", "runs")
    out["dq_flatline"] = sql(f"""SELECT {sl}, 'bar.flatline' AS "check", 'minor' AS severity, max(len) AS "count"
        FROM runs GROUP BY 1, 2, 3 HAVING max(len) >= 5""", "runs")
    cte("rough", """SELECT * REPLACE (CASE WHEN seq % 500 = 1 THEN price * 3 WHEN seq % 700 = 2 THEN -price
        ELSE price END AS price, CAST(CASE WHEN seq % 90 = 4 THEN 5 ELSE side END AS TINYINT) AS side)
        FROM fx_trades""", "fx_trades")
    cte("rough_med", f"SELECT {sl}, median(price) AS med, count(*) AS n FROM rough GROUP BY 1, 2, 3", "rough")
    out["dq_trades"] = issues(
        f"""SELECT {sl}, count(*) FILTER (price <= 0) AS px, count(*) FILTER (size <= 0) AS sz,
            count(*) FILTER (side NOT IN (-1, 0, 1)) AS sd,
            count(trade_id) FILTER (trade_id <> '') - count(DISTINCT CASE WHEN trade_id <> '' THEN trade_id END) AS dup,
            count(*) FILTER (n >= 20 AND med > 0 AND abs(price - med) / med > 0.5) AS ext,
            count(*) FILTER ((recv_ns - ts_ns) / 1e6 > 5000) AS stale
            FROM rough JOIN rough_med USING ({sl}) GROUP BY 1, 2, 3""",
        [("trade.nonpositive_price", "critical", "px"), ("trade.nonpositive_size", "major", "sz"),
         ("trade.bad_side", "minor", "sd"), ("trade.duplicate_trade_id", "major", "dup"),
         ("trade.extreme_price", "major", "ext"), ("trade.high_receive_lag", "minor", "stale")],
        "rough", "rough_med")
    out["lag_p99"] = sql(f"""SELECT {sl}, {r('quantile_cont((recv_ns - ts_ns) + seq % 1000000, 0.99) / 1e6', 4)} AS p99_ms
        FROM fx_trades GROUP BY 1, 2, 3""", "fx_trades")
    out["dq_quotes"] = issues(
        f"""SELECT {sl}, count(*) FILTER (a < b - 1e-12) AS crossed, count(*) FILTER (a = b) AS locked,
            count(*) FILTER (a <= 0 OR b <= 0) AS px,
            count(*) FILTER ((a - b) / nullif((a + b) / 2, 0) * 1e4 > 500) AS wide
            FROM (SELECT *, CASE WHEN seq % 300 = 9 THEN 0 ELSE bid_px END AS b,
                  CASE WHEN seq % 170 = 9 THEN ask_px + 20 ELSE ask_px END AS a FROM fx_quotes) q GROUP BY 1, 2, 3""",
        [("quote.crossed_book", "major", "crossed"), ("quote.locked_book", "info", "locked"),
         ("quote.nonpositive_price", "critical", "px"), ("quote.implausible_spread", "minor", "wide")], "fx_quotes")
    cte("ext", """SELECT symbol, date, ts_ns, min(close) FILTER (venue <> 'agg') AS lo,
        max(close) FILTER (venue <> 'agg') AS hi, max(close) FILTER (venue = 'agg') AS a,
        count(*) FILTER (venue = 'agg') AS nt, count(*) FILTER (venue <> 'agg') AS nv
        FROM bars GROUP BY 1, 2, 3""", "bars")
    breach = "a < lo - (abs(lo) * 1e-6 + 1e-9) OR a > hi + (abs(hi) * 1e-6 + 1e-9)"
    out["dq_agg_range"] = sql(f"""SELECT symbol, 'agg' AS venue, date, 'agg.outside_venue_range' AS "check",
        'major' AS severity, count(*) FILTER ({breach}) AS "count" FROM ext GROUP BY symbol, date
        HAVING count(*) FILTER ({breach}) > 0""", "ext")
    cte("disp", """SELECT symbol, date, ts_ns, (hi - lo) / ((hi + lo) / 2) * 1e4 AS bps FROM ext
        WHERE nv > 0""", "ext")
    out["dq_dispersion"] = sql("""SELECT symbol, 'agg' AS venue, date, 'xvenue.dispersion' AS "check",
        CASE WHEN quantile_cont(bps, 0.99) < 200 THEN 'minor' ELSE 'major' END AS severity,
        count(*) FILTER (bps > 50) AS "count" FROM disp GROUP BY symbol, date
        HAVING count(*) FILTER (bps > 50) > 0""", "disp")
    cte("diffs", f"""SELECT {sl}, ts_ns, (ts_ns - lag(ts_ns) OVER (PARTITION BY {sl} ORDER BY ts_ns)) / 1e9 AS gap_s
        FROM bars""", "bars")
    cte("comp", f"""SELECT {sl}, count(*) AS bars, (max(ts_ns) - min(ts_ns)) // 1000000000 + 1 AS span_seconds,
        CAST(floor(coalesce(max(gap_s), 0)) AS BIGINT) AS max_gap_seconds FROM diffs GROUP BY 1, 2, 3""", "diffs")
    cte("comp2", f"""SELECT *, span_seconds AS expected_bars,
        {r('100.0 * least(1.0, bars / span_seconds)', 4)} AS completeness_pct FROM comp""", "comp")
    out["completeness"] = sql("SELECT * FROM comp2", "comp2")
    cte("cov", f"""SELECT symbol, date, 'agg' AS venue, count(*) FILTER (nv > 0) AS union_seconds,
        count(*) FILTER (nv > 0 AND nt > 0) AS covered_seconds,
        {r('count(*) FILTER (nv > 0 AND nt > 0) * 100.0 / count(*) FILTER (nv > 0)', 2)} AS pct
        FROM ext GROUP BY 1, 2""", "ext")
    out["agg_union_coverage"] = sql("SELECT symbol, date, venue, union_seconds, covered_seconds, "
                                    "pct AS agg_coverage_of_union_pct FROM cov", "cov")
    # every check over the plain views, as one issue list
    cte("tmed", f"SELECT {sl}, median(price) AS med, count(*) AS n FROM fx_trades GROUP BY 1, 2, 3", "fx_trades")
    cte("tst", f"""SELECT {sl}, count(*) FILTER (price <= 0) AS px, count(*) FILTER (size <= 0) AS sz,
        count(trade_id) - count(DISTINCT trade_id) AS dup,
        count(*) FILTER (n >= 20 AND med > 0 AND abs(price - med) / med > 0.5) AS ext,
        count(*) FILTER (recv_ns - ts_ns > 5000000000) AS stale
        FROM fx_trades JOIN tmed USING ({sl}) GROUP BY 1, 2, 3""", "fx_trades", "tmed")
    cte("qst", f"""SELECT {sl}, count(*) FILTER (ask_px < bid_px - 1e-12) AS crossed,
        count(*) FILTER (ask_px = bid_px) AS locked,
        count(*) FILTER ((ask_px - bid_px) / ((ask_px + bid_px) / 2) * 1e4 > 500) AS wide
        FROM fx_quotes GROUP BY 1, 2, 3""", "fx_quotes")
    cte("gth", f"""SELECT {sl}, greatest(60.0, 30.0 * median(gap_s)) AS warn, greatest(600.0, 120.0 * median(gap_s)) AS major
        FROM diffs WHERE gap_s IS NOT NULL GROUP BY 1, 2, 3""", "diffs")
    cte("gst", f"""SELECT {sl}, count(*) FILTER (gap_s > 1.5 AND gap_s >= warn) AS w,
        count(*) FILTER (gap_s > 1.5 AND gap_s >= major) AS m FROM diffs JOIN gth USING ({sl}) GROUP BY 1, 2, 3""",
        "diffs", "gth")
    cte("vst", f"""SELECT {sl}, count(*) FILTER (high < greatest(open, close) - 1e-9) AS hi,
        count(*) FILTER (low > least(open, close) + 1e-9) AS lo, count(*) FILTER (high < low - 1e-9) AS hl,
        count(*) FILTER (vwap < low - 1e-6 OR vwap > high + 1e-6) AS vw FROM bars GROUP BY 1, 2, 3""", "bars")
    cte("fruns", f"""SELECT {sl}, max(len) AS longest FROM (SELECT {sl}, run, count(*) AS len FROM (SELECT {sl},
        sum(CASE WHEN prev IS NULL OR close <> prev THEN 1 ELSE 0 END)
            OVER (PARTITION BY {sl} ORDER BY ts_ns ROWS UNBOUNDED PRECEDING) AS run
        FROM (SELECT {sl}, ts_ns, close, lag(close) OVER (PARTITION BY {sl} ORDER BY ts_ns) AS prev FROM bars) a) b
        GROUP BY {sl}, run) c GROUP BY 1, 2, 3""", "bars")

    def part(src: str, check: str, sev: str, n: str, weight: float | str) -> str:
        sev = sev if sev.startswith("CASE") else f"'{sev}'"
        return f"SELECT {sl}, '{check}' AS chk, {sev} AS sev, CAST({n} AS BIGINT) AS cnt FROM {src} WHERE {n} > 0"

    cte("dst", "SELECT symbol, 'agg' AS venue, date, count(*) FILTER (bps > 50) AS n, "
               "quantile_cont(bps, 0.99) AS p99 FROM disp GROUP BY 1, 3", "disp")
    cte("rst", f"SELECT symbol, 'agg' AS venue, date, count(*) FILTER ({breach}) AS n FROM ext GROUP BY 1, 3", "ext")
    cte("iss", " UNION ALL ".join([
        part("tst", "trade.nonpositive_price", "critical", "px", 30),
        part("tst", "trade.nonpositive_size", "major", "sz", 10),
        part("tst", "trade.duplicate_trade_id", "major", "dup", 10),
        part("tst", "trade.extreme_price", "major", "ext", 10),
        part("tst", "trade.high_receive_lag", "minor", "stale", 2),
        part("qst", "quote.crossed_book", "major", "crossed", 10),
        part("qst", "quote.locked_book", "info", "locked", 0),
        part("qst", "quote.implausible_spread", "minor", "wide", 2),
        part("gst", "bar.gaps", "CASE WHEN m > 0 THEN 'major' ELSE 'minor' END", "w", 0),
        part("vst", "bar.high_below_body", "major", "hi", 10), part("vst", "bar.low_above_body", "major", "lo", 10),
        part("vst", "bar.high_below_low", "critical", "hl", 30), part("vst", "bar.vwap_outside_hl", "major", "vw", 10),
        part("fruns", "bar.flatline", "minor", "CASE WHEN longest >= 120 THEN longest ELSE 0 END", 2),
        part("dst", "xvenue.dispersion", "CASE WHEN p99 < 200 THEN 'minor' ELSE 'major' END", "n", 0),
        part("rst", "agg.outside_venue_range", "major", "n", 10)]),
        "tst", "qst", "gst", "vst", "fruns", "dst", "rst")
    cte("pen", f"""SELECT {sl}, count(*) AS n_issues, CAST(sum(CASE sev WHEN 'minor' THEN 2 WHEN 'major' THEN 10
        WHEN 'critical' THEN 30 ELSE 0 END) AS DOUBLE) AS penalty,
        count(*) FILTER (sev = 'critical') AS n_critical, count(*) FILTER (sev = 'major') AS n_major,
        count(*) FILTER (sev = 'minor') AS n_minor, count(*) FILTER (sev = 'info') AS n_info,
        array_to_string(list(chk || ':' || sev || ':' || CAST(cnt AS VARCHAR) ORDER BY
           CASE sev WHEN 'critical' THEN 0 WHEN 'major' THEN 1 WHEN 'minor' THEN 2 ELSE 3 END, chk), ';') AS issues
        FROM iss GROUP BY 1, 2, 3""", "iss")
    out["run_checks"] = sql(f"SELECT {sl}, chk AS \"check\", sev AS severity, cnt AS \"count\" FROM iss", "iss")
    out["quality_score"] = sql(f"SELECT {sl}, penalty, n_issues, n_critical, n_major, n_minor, n_info, issues "
                               "FROM pen", "pen")
    cte("card", f"""SELECT c.symbol, c.venue, c.date, c.bars, c.expected_bars, c.completeness_pct, c.max_gap_seconds,
        c.span_seconds, v.union_seconds, v.pct AS agg_coverage_of_union_pct,
        CASE WHEN c.venue = 'agg' THEN coalesce(v.pct, 100.0) ELSE 100.0 END AS score_base_pct,
        {r("greatest(0.0, least(100.0, CASE WHEN c.venue = 'agg' THEN coalesce(v.pct, 100.0) ELSE 100.0 END - coalesce(p.penalty, 0)))", 2)} AS score,
        {r('span_seconds * 100.0 / 86400', 2)} AS day_coverage_pct,
        coalesce(t.n, 0) AS n_trades, coalesce(q.n, 0) AS n_quotes, coalesce(n_issues, 0) AS n_issues,
        coalesce(n_critical, 0) AS n_critical, coalesce(n_major, 0) AS n_major, coalesce(n_minor, 0) AS n_minor,
        coalesce(n_info, 0) AS n_info,
        CASE WHEN c.venue = 'agg' THEN 'coverage_of_contributing_venues' ELSE 'clean_baseline' END AS score_basis,
        coalesce(p.issues, '') AS issues
        FROM comp2 c LEFT JOIN cov v USING ({sl}) LEFT JOIN pen p USING ({sl})
        LEFT JOIN (SELECT {sl}, count(*) AS n FROM fx_trades GROUP BY 1, 2, 3) t USING ({sl})
        LEFT JOIN (SELECT {sl}, count(*) AS n FROM fx_quotes GROUP BY 1, 2, 3) q USING ({sl})""",
        "comp2", "cov", "pen", "fx_trades", "fx_quotes")
    cte("card2", """SELECT *, CASE WHEN score >= 95 THEN 'A' WHEN score >= 85 THEN 'B' WHEN score >= 70 THEN 'C'
        WHEN score >= 50 THEN 'D' ELSE 'F' END AS grade FROM card""", "card")
    out["score_day"] = sql("SELECT * FROM card2", "card2")
    out["daily_quality"] = sql("SELECT date, symbol, venue, score, grade, score_base_pct, bars, expected_bars, "
                               "completeness_pct, max_gap_seconds, n_issues, n_critical FROM card2", "card2")
    out["quality_summary"] = sql(
        f"""SELECT count(*) AS slices, array_to_string(list_sort(list(DISTINCT symbol)), ',') AS symbols,
            array_to_string(list_sort(list(DISTINCT venue)), ',') AS venues,
            array_to_string(list_sort(list(DISTINCT date)), ',') AS dates, {r('avg(score)', 2)} AS mean_score,
            {r('min(score)', 2)} AS min_score, """
        + ", ".join(f"count(*) FILTER (grade = '{g}') AS grade_{g.lower()}" for g in "ABCDF")
        + ", CAST(sum(n_critical) AS BIGINT) AS total_critical_issues FROM card2", "card2")
    out["quality_offenders"] = sql(f"SELECT {sl}, chk AS \"check\", sev AS severity, cnt AS \"count\" FROM iss "
                                   "WHERE sev IN ('major', 'critical')", "iss")
    out["quality_latest"] = sql(
        "SELECT symbol, venue, score, grade, completeness_pct, n_critical, date FROM card2 "
        "WHERE (symbol, venue, date) IN (SELECT (symbol, venue, max(date)) FROM card2 GROUP BY symbol, venue)",
        "card2")
    out["ts_out_of_order"] = sql(
        f"""SELECT {sl}, count(*) FILTER (t < prev) AS n_decreases FROM (SELECT {sl}, t,
            lag(t) OVER (PARTITION BY {sl} ORDER BY seq) AS prev FROM (SELECT {sl}, seq,
            CASE WHEN seq % 9 = 0 THEN ts_ns - 3000000000 ELSE ts_ns END AS t FROM fx_trades) a) b
            GROUP BY 1, 2, 3""", "fx_trades")
    return out


def oracles() -> dict[str, str]:
    return {**tape_oracles(), **bar_oracles(), **query_oracles(), **quality_oracles()}
