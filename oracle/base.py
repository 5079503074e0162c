"""Shared table expressions of the oracle, independent of the Spark operators."""

from __future__ import annotations

from marketlake.plans.market_views import TEXTS

DAY_NS = 86_400_000_000_000


def date_of(ns: str) -> str:
    return f"strftime(make_timestamp(({ns}) // 1000), '%Y-%m-%d')"


BIT = ("CASE venue WHEN 'binance' THEN 1 WHEN 'binance_futures' THEN 2 WHEN 'bitfinex' THEN 4 "
       "WHEN 'bitstamp' THEN 8 WHEN 'bybit' THEN 16 WHEN 'coinbase' THEN 32 WHEN 'gemini' THEN 64 "
       "WHEN 'kraken' THEN 128 WHEN 'okx' THEN 256 ELSE 0 END")

TAPE = """
WITH f AS (SELECT *, (ts_ns // 1000000000) * 1000000000 AS sec FROM {src}
           WHERE venue <> 'bybit' AND size > 0 AND recv_ns - ts_ns <= 5000000000),
m AS (SELECT symbol, sec, median(price) med, count(DISTINCT venue) nv, count(*) nraw FROM f GROUP BY 1, 2),
d AS (SELECT f.*, m.med, m.nv, m.nraw, abs(price - med) ad FROM f JOIN m USING (symbol, sec)),
m2 AS (SELECT symbol, sec, median(ad) mad FROM d GROUP BY 1, 2),
k AS (SELECT d.* FROM d JOIN m2 USING (symbol, sec)
      WHERE nv < 3 OR (mad <= 0 AND ad <= greatest(med * 1e-3, 1e-12)) OR (mad > 0 AND ad <= 5.0 * (mad * 1.4826))),
b AS (SELECT symbol, sec, first(price ORDER BY ts_ns, recv_ns, venue, seq) AS open, max(price) AS high,
             min(price) AS low, last(price ORDER BY ts_ns, recv_ns, venue, seq) AS close, sum(size) AS volume,
             sum(price * size) / sum(size) AS vwap, count(*) AS n_kept,
             bit_or({bit}) AS sources_mask, max(ingested_at_ns) AS kept_ingested,
             list_sort(list(DISTINCT venue)) AS kept_venues FROM k GROUP BY 1, 2),
r AS (SELECT symbol, sec, max(ingested_at_ns) AS ingested_at_ns, list_sort(list(DISTINCT venue)) AS raw_venues
      FROM f GROUP BY 1, 2)
SELECT m.sec AS ts_ns, m.symbol, 'agg' AS venue, open, high, low, close, volume, vwap,
       CAST(coalesce(n_kept, 0) AS INTEGER) AS trades, CAST(sources_mask AS INTEGER) AS sources_mask,
       r.ingested_at_ns, m.nraw AS n_raw, coalesce(n_kept, 0) AS n_kept,
       m.nraw - coalesce(n_kept, 0) AS n_dropped, m.med AS median_px,
       CASE WHEN n_kept > 0 THEN kept_venues ELSE raw_venues END AS venues
FROM m JOIN r USING (symbol, sec) LEFT JOIN b USING (symbol, sec)
"""

VENUE_BARS = """
SELECT (ts_ns // 1000000000) * 1000000000 AS ts_ns, symbol, venue,
       first(price ORDER BY ts_ns, seq) AS open, max(price) AS high, min(price) AS low,
       last(price ORDER BY ts_ns, seq) AS close, sum(size) AS volume,
       CASE WHEN sum(size) > 0 THEN sum(price * size) / sum(size)
            ELSE last(price ORDER BY ts_ns, seq) END AS vwap,
       CAST(count(*) AS INTEGER) AS trades, 0 AS sources_mask, max(ingested_at_ns) AS ingested_at_ns
FROM {src} GROUP BY ts_ns // 1000000000, symbol, venue
"""

BAR_COLS = "ts_ns, symbol, venue, open, high, low, close, volume, vwap, trades, sources_mask, ingested_at_ns"

# name → (text, names it needs)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "fx_trades": (TEXTS["fx_trades"].replace("{events}", "events"), ()),
    **{n: (TEXTS[n].replace("{fx_trades}", "fx_trades"), ("fx_trades",))
       for n in ("fx_quotes", "fx_funding", "fx_oi", "fx_status", "fx_corrections")},
    "fx_listed": (TEXTS["fx_listed"].replace("{fx_trades}", "fx_trades"), ("fx_trades",)),
    "fx_symbol_map": (TEXTS["fx_symbol_map"].replace("{fx_listed}", "fx_listed"), ("fx_listed",)),
    "fx_books": ("""SELECT ts_ns, recv_ns, symbol, venue, CAST(3 AS SMALLINT) AS depth,
        list_transform([0, 1, 2], lambda j: {'px': bid_px - 0.1::DOUBLE * j, 'sz': bid_sz + j}) AS bids,
        list_transform([0, 1, 2], lambda j: {'px': ask_px + 0.1::DOUBLE * j, 'sz': ask_sz + j}) AS asks,
        ingested_at_ns, seq FROM fx_quotes""", ("fx_quotes",)),
    "vbars": (VENUE_BARS.replace("{src}", "fx_trades"), ("fx_trades",)),
    "tape_all": (TAPE.replace("{src}", "fx_trades").replace("{bit}", BIT), ("fx_trades",)),
    "tape": (f"SELECT {BAR_COLS} FROM tape_all WHERE n_kept > 0", ("tape_all",)),
    "bars": (f"SELECT *, {date_of('ts_ns')} AS date FROM (SELECT {BAR_COLS} FROM vbars UNION ALL "
             f"SELECT {BAR_COLS} FROM tape) u", ("vbars", "tape")),
}


def cte(name: str, text: str, *needs: str) -> str:
    CTES[name] = (text, needs)
    return name


def sql(final: str, *needs: str) -> str:
    """``final`` with every needed table expression, dependencies first."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in CTES[name][1]:
            visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]})" for n in ordered) + "\n" + final


def r(expr: str, digits: int = 6) -> str:
    """Round like the Spark side does: nudged off exact halves, and without negative zero."""
    return f"(round({expr} + 1e-11, {digits}) + 0.0)"


def rounded(columns: str, digits: int = 6) -> str:
    return ", ".join(f"{r(c, digits)} AS {c}" for c in columns.split())
