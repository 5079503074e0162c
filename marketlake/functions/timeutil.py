"""Nanosecond time keys: parsing, flooring, dates and timeframes."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

US = 1_000
MS = 1_000_000
SECOND = 1_000_000_000
MINUTE = 60 * SECOND
HOUR = 3600 * SECOND
DAY = 86_400 * SECOND
WEEK = 7 * DAY


def to_ns(t) -> int:
    """An int is nanoseconds already; anything else is parsed, naive meaning UTC."""
    if isinstance(t, int):
        return t
    instant = pd.to_datetime([t], utc=True)  # naive entries are read as UTC, others converted
    return int(instant.as_unit("ns").asi8[0])


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor_ns(c, step: int, origin: Column | int = 0) -> Column:
    """Largest ``origin + k*step`` not above the value, also for negatives."""
    c = _col(c)
    origin = origin if isinstance(origin, Column) else F.lit(origin).cast("long")
    return c - F.pmod(c - origin, F.lit(step).cast("long"))


def idiv(a, b) -> Column:
    """Integer division of longs, truncating; exact where ``/`` would go through double."""
    a, b = (x if isinstance(x, Column) else F.lit(x).cast("long") for x in (a, b))
    return F.call_function("div", a, b)


def second_of(c="ts_ns") -> Column:
    return floor_ns(c, SECOND)


def hour_bucket(c="ts_ns") -> Column:
    """Rotation key: whole hours since the epoch."""
    return idiv(floor_ns(c, HOUR), HOUR)


def ts_of(c="ts_ns") -> Column:
    """Display timestamp (microseconds). Never used as a key."""
    c = _col(c)
    return F.timestamp_micros(idiv(floor_ns(c, US), US))


def date_of(c="ts_ns") -> Column:
    """UTC date string of a nanosecond key, independent of the session zone."""
    c = _col(c)
    days = idiv(floor_ns(c, DAY), DAY).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")


def date_text(ns: int) -> str:
    return pd.Timestamp(ns, unit="ns", tz="UTC").strftime("%Y-%m-%d")


@dataclass(frozen=True)
class Timeframe:
    """Bar width in ns, and where its grid starts.

    ``anchored`` frames do not divide a day, so their grid starts at midnight of
    the first day of each series instead of a fixed origin.
    """

    step: int
    origin: int = 0
    anchored: bool = False


# Named timeframes.
NAMED_FRAMES = ("1s", "5s", "10s", "15s", "30s", "1m", "2m", "3m", "5m", "15m", "30m",
                "1h", "2h", "4h", "6h", "12h", "1d", "1w")
_UNIT = {"s": SECOND, "m": MINUTE, "h": HOUR, "d": DAY}
_WEEK_ORIGIN = 3 * DAY  # weekly bars close on Sunday 1970-01-04 and every seventh day after


def parse_timeframe(timeframe: str) -> Timeframe:
    """Named frames, else any fixed pandas frequency. Case is ignored, so 1M is a minute."""
    text = timeframe.strip().lower()
    if text == "1w":
        return Timeframe(WEEK, _WEEK_ORIGIN)
    if text in NAMED_FRAMES:
        step = int(text[:-1]) * _UNIT[text[-1]]
    else:
        step = int(pd.Timedelta(pd.tseries.frequencies.to_offset(text)).value)
    return Timeframe(step, anchored=DAY % step != 0)
