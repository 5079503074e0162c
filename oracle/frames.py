"""Oracle texts of the message queries: the rows the messages were rendered from."""

from __future__ import annotations

from market_fixtures.frame_views import CANONICAL
from marketlake.plans.market_views import TEXTS
from oracle.base import VENUE_BARS, cte, r, rounded, sql

S = 1_000_000_000
TEXT = TEXTS["fx_trades"].replace("{events}", "events")


def symbol(venue: str) -> str:
    a, b = CANONICAL[venue]
    return f"CASE symbol WHEN 'SYM0' THEN '{a}' ELSE '{b}' END AS symbol, '{venue}' AS venue"


LIVE = "symbol <> 'SYM2' AND seq % 97 <> 0"


def side(venue: str) -> str:
    """Signed amounts cannot tell an empty buy from a sell."""
    bought = "side = 1 AND size > 0" if venue == "bitfinex" else "side = 1"
    return f"CAST(CASE WHEN {bought} THEN 1 ELSE -1 END AS TINYINT) AS side"


def oracles() -> dict[str, str]:
    out = {}
    cte("landed", " UNION ALL ".join(
        f"SELECT ts_ns - ts_ns % {S} AS ts_ns, recv_ns, {symbol(v)}, price, size, seq, ingested_at_ns "
        f"FROM fx_trades WHERE {LIVE} AND venue = '{v}'" for v in ("coinbase", "kraken")), "fx_trades")
    cte("landed_bars", VENUE_BARS.replace("{src}", "landed").replace("ts_ns, seq", "ts_ns, recv_ns, seq % 4, seq"), "landed")
    out["bars_from_frames"] = sql(
        f"SELECT ts_ns, symbol, venue, {rounded('open high low close volume vwap')}, trades, sources_mask FROM landed_bars",
        "landed_bars")
    for v in ("binance", "coinbase", "kraken", "bybit", "okx", "bitstamp", "gemini", "bitfinex"):
        out[f"norm_{v}_trades"] = sql(
            f"SELECT ts_ns, recv_ns, {symbol(v)}, price, size, {side(v)}, CAST(seq AS VARCHAR) AS trade_id "
            f"FROM fx_trades WHERE {LIVE}", "fx_trades")
        ts = {"binance": "recv_ns - 1000000", "kraken": "recv_ns", "bitfinex": "recv_ns",
              "bitstamp": "ts_ns - ts_ns % 1000000000"}.get(v, "ts_ns")
        ask_sz = "0.0::DOUBLE" if v in ("coinbase", "kraken") else "ask_sz"
        if v != "gemini":
            out[f"norm_{v}_quotes"] = sql(
                f"SELECT {ts} AS ts_ns, recv_ns, {symbol(v)}, {r('bid_px')} AS bid_px, {r('ask_px')} AS ask_px, "
                f"bid_sz, {ask_sz} AS ask_sz FROM fx_quotes WHERE {LIVE}", "fx_quotes")
        hit = {"coinbase": "both", "okx": "both", "bitstamp": "both", "gemini": "both", "kraken": "end",
               "bitfinex": "end"}.get(v, "none")
        t = "ts_ns - ts_ns % 1000000000" if v in ("bitstamp", "kraken") else "ts_ns"
        page = f"ts_ns - ts_ns % {5 * S}"
        cond = {"both": f"{t} >= {page} + {S} AND {t} <= {page} + {3 * S}", "end": f"{t} <= {page} + {3 * S}",
                "none": "TRUE"}[hit]
        out[f"rest_{v}_trades"] = sql(
            f"SELECT {t} AS ts_ns, {t} AS recv_ns, symbol, '{v}' AS venue, price, size, {side(v)}, "
            f"CAST(seq AS VARCHAR) AS trade_id FROM fx_trades WHERE {cond}", "fx_trades")
    # running best over the messages of a ticker: largest (price, position), the later one on equal prices
    cte("gq", f"""SELECT recv_ns, seq, symbol,
        max({{'k': bid_px, 'r': recv_ns, 's': seq, 'q': bid_sz}}) OVER w AS b,
        max({{'k': -ask_px, 'r': recv_ns, 's': seq, 'q': ask_sz}}) OVER w AS a
        FROM fx_quotes WHERE {LIVE} WINDOW w AS (PARTITION BY symbol ORDER BY recv_ns, seq ROWS UNBOUNDED PRECEDING)""",
        "fx_quotes")
    out["norm_gemini_quotes"] = sql(
        f"SELECT recv_ns AS ts_ns, recv_ns, {symbol('gemini')}, {r('b.k')} AS bid_px, {r('-a.k')} AS ask_px, "
        "b.q AS bid_sz, a.q AS ask_sz FROM gq", "gq")
    for v in ("bybit", "binance_futures"):
        nxt = "CASE WHEN seq % 3 = 0 THEN NULL ELSE recv_ns END" if v == "bybit" else "recv_ns"
        more = " AND seq % 5 <> 0" if v == "bybit" else ""
        out[f"norm_{v}_funding"] = sql(
            f"SELECT ts_ns, recv_ns, {symbol(v)}, size AS funding_rate, price AS mark_price, {nxt} AS next_ts_ns "
            f"FROM fx_trades WHERE {LIVE}{more}", "fx_trades")
        out[f"norm_{v}_oi"] = sql(
            f"SELECT ts_ns, recv_ns, {symbol(v)}, price AS oi_base, CAST(NULL AS DOUBLE) AS oi_quote "
            f"FROM fx_trades WHERE {LIVE}", "fx_trades")
        out[f"rest_{v}_funding"] = sql(
            f"SELECT ts_ns, ts_ns AS recv_ns, symbol, '{v}' AS venue, size AS funding_rate, "
            "CAST(NULL AS DOUBLE) AS mark_price, CAST(NULL AS BIGINT) AS next_ts_ns FROM fx_trades", "fx_trades")
    ladder = "array_to_string(list_transform({s}, lambda x: CAST(round(x.px, 4) AS VARCHAR) || '@' || CAST(x.sz AS VARCHAR)), ' ')"
    out["norm_binance_book"] = sql(
        f"SELECT recv_ns AS ts_ns, recv_ns, {symbol('binance')}, CAST(10 AS SMALLINT) AS depth, "
        f"{ladder.format(s='bids')} AS bids, {ladder.format(s='asks')} AS asks FROM fx_books WHERE {LIVE}", "fx_books")
    page = f"ts_ns - ts_ns % {60 * S}"
    bounds = {"kraken": "both", "gemini": "both", "okx": "start", "bitfinex": "end"}
    for v in ("binance", "binance_futures", "coinbase", "kraken", "bybit", "okx", "bitstamp", "gemini", "bitfinex"):
        cond = {"both": f"ts_ns >= {page} + {12 * S} AND ts_ns <= {page} + {36 * S}",
                "start": f"ts_ns >= {page} + {12 * S}", "end": f"ts_ns <= {page} + {36 * S}"}.get(
            bounds.get(v, ""), "TRUE")
        n = "trades" if v in ("binance", "binance_futures", "kraken") else "0"
        cols = ", ".join(f"(round({c}, 6) + 0.0) AS {c}" for c in ("open", "high", "low", "close", "volume"))
        out[f"norm_{v}_klines"] = sql(f"SELECT ts_ns, symbol, '{v}' AS venue, {cols}, {n} AS trades FROM vbars "
                                      f"WHERE {cond}", "vbars")
    for v in ("coinbase", "kraken"):
        out[f"norm_{v}_book"] = book_text(v)
    return out


def book_text(v: str) -> str:
    """Emission times by recursion (first message five seconds on), then the last update of
    every level up to each emission, after the last clear."""
    snapshot = "seq % 400 = 0" if v == "kraken" else "FALSE"
    return f"""WITH RECURSIVE u AS (
      SELECT {symbol(v)}, recv_ns, seq, seq % 2 = 0 AS is_bid, round(price, 1) AS px, size AS qty,
             {snapshot} AS clear FROM ({TEXT}) f WHERE {LIVE}),
    first_of AS (SELECT symbol, min(recv_ns) AS t FROM u GROUP BY 1),
    em(symbol, t) AS (SELECT symbol, t FROM first_of UNION ALL
      SELECT symbol, (SELECT min(recv_ns) FROM u WHERE u.symbol = em.symbol AND u.recv_ns >= em.t + {5 * S}) AS t2
      FROM em WHERE t2 IS NOT NULL),
    -- the emission happens at the first message of its instant
    ev AS (SELECT e.symbol, e.t, min(u.seq) AS s FROM (SELECT DISTINCT * FROM em WHERE t IS NOT NULL) e
           JOIN u ON u.symbol = e.symbol AND u.recv_ns = e.t GROUP BY 1, 2),
    cl AS (SELECT ev.symbol, ev.t, max((u.recv_ns, u.seq)) AS c FROM ev JOIN u ON u.symbol = ev.symbol AND u.clear
           AND (u.recv_ns, u.seq) <= (ev.t, ev.s) GROUP BY 1, 2),
    lv AS (SELECT ev.symbol, ev.t, u.is_bid, u.px, last(u.qty ORDER BY u.recv_ns, u.seq) AS qty
           FROM ev JOIN u ON u.symbol = ev.symbol AND (u.recv_ns, u.seq) <= (ev.t, ev.s)
           LEFT JOIN cl ON cl.symbol = ev.symbol AND cl.t = ev.t
           WHERE cl.c IS NULL OR (u.recv_ns, u.seq) >= cl.c GROUP BY 1, 2, 3, 4),
    rk AS (SELECT *, row_number() OVER (PARTITION BY symbol, t, is_bid ORDER BY CASE WHEN is_bid THEN -px ELSE px END)
           AS k FROM lv WHERE qty <> 0),
    tx AS (SELECT symbol, t, is_bid, string_agg(CAST(px AS VARCHAR) || '@' || CAST(qty AS VARCHAR), ' ' ORDER BY k)
           AS txt FROM rk WHERE k <= 5 GROUP BY 1, 2, 3)
    SELECT ev.t AS ts_ns, ev.t AS recv_ns, ev.symbol, '{v}' AS venue, CAST(5 AS SMALLINT) AS depth,
           coalesce(b.txt, '') AS bids, coalesce(a.txt, '') AS asks
    FROM ev LEFT JOIN tx b ON b.symbol = ev.symbol AND b.t = ev.t AND b.is_bid
            LEFT JOIN tx a ON a.symbol = ev.symbol AND a.t = ev.t AND NOT a.is_bid"""
