"""Parsing helpers. The outer object of a message is typed, so one pass decodes it; payloads
stay string maps, because some venues' keys differ by case only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.ordered import as_of
from marketlake.functions.timeutil import MS, floor_ns
from marketlake.schemas import SCHEMAS
from marketlake.sources.arrival import POSITION, message_position
from marketlake.sources.venues import canonical_of

OBJECT, LIST = "map<string,string>", "array<map<string,string>>"
#: Sequence numbers of a connection that are handled together.
RUN = 1 << 16


def jmap(c) -> Column:
    return F.from_json(c, OBJECT)


def jmaps(c) -> Column:
    return F.from_json(c, LIST)


def jlist(c) -> Column:
    return F.from_json(c, "array<string>")


def jtable(c) -> Column:
    return F.from_json(c, "array<array<string>>")


def num(c: Column) -> Column:
    return c.try_cast("double")


def whole(c: Column) -> Column:
    return c.try_cast("long")


def ms_ns(c: Column) -> Column:
    return whole(c) * F.lit(MS)


def iso_ns(c: Column) -> Column:
    return F.unix_micros(F.try_to_timestamp(c)) * F.lit(1000)


def present(c: Column) -> Column:
    """The text, with the empty string read as missing."""
    return F.nullif(c, F.lit(""))


def cell(row: Column, i: int) -> Column:
    return F.get(row, F.lit(i))


def recv_ms_ns() -> Column:
    """Receive time cut to whole milliseconds, where a message carries no own time."""
    return floor_ns("recv_ns", MS)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed exactly once per row. The optimiser would copy a plain
    projection into every later filter, and decode each message many times over; it
    does not move filters below a generator."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def of_venue(frames: DataFrame, venue: str, **fields: str) -> DataFrame:
    """Frames of one venue with the decoded object in ``msg`` (null when undecodable). ``fields``
    names the members read and their types; other members are skipped."""
    schema = ", ".join(f"{name} {kind}" for name, kind in fields.items())
    return once(frames.where(F.col("venue") == venue), "msg", F.from_json("raw", schema))


def msg(key: str) -> Column:
    return F.col("msg")[key]


def rows_as(df: DataFrame, table: str, venue: str, required: tuple[str, ...], **columns: Column) -> DataFrame:
    """Project parsed columns into the table layout; rows lacking a required value are dropped.

    Rows of a message carry its position (``_event`` is their place in it), which storing them keeps. The ingest
    time is the moment of the job, as nothing in a message tells it.
    """
    columns.setdefault("recv_ns", F.col("recv_ns"))
    columns["venue"] = F.lit(venue)
    columns["ingested_at_ns"] = F.unix_micros(F.current_timestamp()) * 1000
    at = message_position(df, F.col("_event") if "_event" in df.columns else None)
    out = df.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                      for f in SCHEMAS[table].fields], *([] if at is None else [at.alias(POSITION)]))
    return out.dropna(subset=["ts_ns", "symbol", *required])


def trade_rows(df: DataFrame, venue: str, native: Column | None = None, symbol: Column | None = None,
               **columns: Column) -> DataFrame:
    columns["symbol"] = symbol if symbol is not None else canonical_of(native, venue)
    return rows_as(df, "trades", venue, ("price", "size"), **columns)


def quote_rows(df: DataFrame, venue: str, native: Column | None = None, symbol: Column | None = None,
               **columns: Column) -> DataFrame:
    columns["symbol"] = symbol if symbol is not None else canonical_of(native, venue)
    return rows_as(df, "quotes", venue, ("bid_px", "ask_px", "bid_sz", "ask_sz"), **columns)


def buy_or_sell(is_buy: Column) -> Column:
    """+1 for a buy aggressor, −1 for anything else, also for a missing side."""
    return F.when(is_buy, 1).otherwise(-1)


def top_of_book(bids: Column, asks: Column) -> dict[str, Column]:
    """Best level of both [px, sz] ladders; null (so dropped) when a side is empty."""
    return {"bid_px": num(cell(cell(bids, 0), 0)), "bid_sz": num(cell(cell(bids, 0), 1)),
            "ask_px": num(cell(cell(asks, 0), 0)), "ask_sz": num(cell(cell(asks, 0), 1))}


def with_channel(frames: DataFrame, venue: str, channel: str) -> DataFrame:
    """Array messages of a channel-numbered feed, each with the symbol its channel stands for.

    The numbering is per connection and holds from its ``subscribed`` message until the
    next one for the same number. Messages meet the subscription that holds at their sequence
    number within runs of sequence numbers, so one connection may carry a whole feed.
    """
    mine = frames.where(F.col("venue") == venue)
    asked = once(mine.where(F.contains("raw", F.lit("subscribed"))), "msg", jmap("raw"))
    subs = (asked.where((msg("event") == "subscribed") & (msg("channel") == channel))
            .select("conn_id", whole(msg("chanId")).alias("chan"), (F.col("seq") + 1).alias("from_seq"),
                    F.coalesce(canonical_of(msg("symbol"), venue), canonical_of(msg("pair"), venue)).alias("symbol"))
            .where(F.col("symbol").isNotNull() & F.col("chan").isNotNull()))
    data = (once(mine.where(F.startswith("raw", F.lit("["))), "parts", jlist("raw"))
            .where(F.size("parts") >= 2).withColumn("chan", whole(cell(F.col("parts"), 0))))
    return as_of(data, subs, ["conn_id", "chan"], "seq", "from_seq", ["symbol"], RUN).where(F.col("symbol").isNotNull())
