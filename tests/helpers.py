"""Small frames with hand-checked values."""

from __future__ import annotations

S = 1_000_000_000
T = 1_700_000_000 * S

TRADES = ("ts_ns long, recv_ns long, symbol string, venue string, price double, size double, side byte, "
          "trade_id string, ingested_at_ns long, seq long")


def trades(spark, rows, symbol="BTC-USDT"):
    """rows: (ts_ns, venue, price, size[, recv_ns[, seq]])"""
    full = []
    for i, row in enumerate(rows):
        ts, venue, price, size = row[:4]
        recv = row[4] if len(row) > 4 and row[4] is not None else ts
        seq = row[5] if len(row) > 5 else i
        full.append((ts, recv, symbol, venue, float(price), float(size), 1, f"t{i}", ts, seq))
    return spark.createDataFrame(full, TRADES)


BARS = ("ts_ns long, symbol string, venue string, open double, high double, low double, close double, "
        "volume double, vwap double, trades int, sources_mask int, ingested_at_ns long, date string")


def bars(spark, rows, symbol="BTC-USD", date="2023-11-14", base=T):
    """rows: dicts over a flat bar; ``s`` is the second."""
    full = []
    for r in rows:
        px = float(r.get("px", 100.0))
        full.append((r.get("ts_ns", base + r.get("s", 0) * S), r.get("symbol", symbol), r.get("venue", "binance"),
                     *[float(r.get(k, px)) for k in ("open", "high", "low", "close")], float(r.get("volume", 1.0)),
                     float(r.get("vwap", px)), r.get("trades", 1), r.get("sources_mask", 0),
                     r.get("ingested_at_ns"), r.get("date", date)))
    return spark.createDataFrame(full, BARS)


def rows(df, *order):
    return [r.asDict() for r in (df.orderBy(*order) if order else df).collect()]
