"""Landed venue messages → canonical rows, batch or stream.

``normalise(frames, venue, stream)`` picks the parser. Frames of other venues,
undecodable messages and unknown symbols are dropped.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from marketlake.sources.frames import level2, pages, quotes, slow, trades

PARSERS = {
    "trades": trades.PARSERS, "quotes": quotes.PARSERS, "funding": slow.FUNDING, "open_interest": slow.OPEN_INTEREST,
    "book_l2_snapshot": {"binance": quotes.binance_book,
                         **{venue: level2.rebuild_from_frames(venue) for venue in level2.LEVEL_EVENTS}},
    # landed pages of the venues' history endpoints
    "rest_trades": {venue: partial(pages.rest_trades, venue=venue) for venue in pages.TRADE_PAGES},
    "rest_funding": {venue: partial(pages.rest_funding, venue=venue) for venue in ("binance_futures", "bybit")},
    "klines": {venue: partial(pages.rest_klines, venue=venue) for venue in pages.KLINE_PAGES},
}


def normalise(frames: DataFrame, venue: str, stream: str, **options) -> DataFrame:
    parsers = PARSERS[stream]
    if venue not in parsers:
        raise KeyError(f"{venue!r} has no {stream}; known: {sorted(parsers)}")
    return parsers[venue](frames, **options)
