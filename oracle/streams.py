"""Oracle texts of the streaming queries: the batch rows of everything the watermark closed."""

from __future__ import annotations

from oracle import frames, reference
from oracle.base import date_of, r, sql
from oracle.market import BARS_OUT

SPOT = "venue <> 'bybit' AND size > 0 AND recv_ns - ts_ns <= 5000000000"


def mark(column: str, where: str = "TRUE") -> str:
    """Watermark in ns: newest event time, in whole milliseconds, minus five seconds."""
    return (f"(SELECT max({column}) - max({column}) % 1000000 - 5000000000 FROM fx_trades WHERE {where})")


def oracles() -> dict[str, str]:
    out = {
        "stream_bars_1s": sql(f"SELECT {BARS_OUT} FROM vbars WHERE ts_ns + 1000000000 <= {mark('ts_ns')}",
                              "fx_trades", "vbars"),
        "stream_tape_1s": sql(f"SELECT {BARS_OUT} FROM tape WHERE ts_ns + 1000000000 <= {mark('ts_ns', SPOT)}",
                              "fx_trades", "tape"),
        "stream_sink": sql(f"SELECT ts_ns, recv_ns, symbol, venue, price, size, side, trade_id, ingested_at_ns, "
                           f"{date_of('ts_ns')} AS date FROM fx_trades", "fx_trades"),
    }
    out["stream_then_append"] = sql(
        f"SELECT (ts_ns - ts_ns % 1000000000) AS ts_ns, symbol, venue, count(*) AS trades, {r('max(price)')} AS high, "
        f"{r('min(price)')} AS low, {r('sum(size)')} AS volume FROM fx_trades GROUP BY 1, 2, 3", "fx_trades")
    reference.oracles()  # registers the health series
    two = "round(recent_per_s + 1e-11, 8) + 0.0 AS recent_per_s"
    out["stream_health"] = sql(
        f"SELECT ts_ns, venue, symbol, stream, {two}, (baseline_per_s = 0 OR recent_per_s >= 0.1 * baseline_per_s) "
        f"AS up FROM series WHERE ts_ns <= {mark('recv_ns')}", "fx_trades", "series")
    texts = frames.oracles()
    out["stream_book"] = texts["norm_coinbase_book"]
    out["stream_bbo"] = texts["norm_gemini_quotes"]
    return out
