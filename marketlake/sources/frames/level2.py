"""Order books rebuilt from level updates.

A book is emitted when at least five seconds passed since its last emission, so both
the levels and the emission times depend on everything before. To keep a hot symbol
distributed, its events are sorted once and cut into blocks of equal numbers of events:

1. emission times follow from the receive times alone (``emission_times``);
2. the levels a block starts with come from grouped last updates, held by a tree over the blocks
   and cut to those that the block can bring to the top (``levels_at_start``);
3. blocks are replayed in parallel from that start (``replay``).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marketlake.functions.ordered import ranked, sorted_blocks
from marketlake.functions.timeutil import MINUTE, SECOND, idiv
from marketlake.schemas import SCHEMAS
from marketlake.session import shared_dir
from marketlake.sources.frames.common import msg, of_venue
from marketlake.sources.frames.trades import coinbase_events, kraken_symbol
from marketlake.sources.store import materialize
from marketlake.sources.venues import canonical_of

EMIT_EVERY_NS = 5 * SECOND  # fixed value
SIDES = ("bid", "ask")
EVENTS = ("symbol string, recv_ns long, seq long, event_no int, clear boolean, "
          "updates array<struct<side:string,px:double,qty:double>>")
SNAPSHOTS = ("ts_ns long, symbol string, bids array<struct<px:double,sz:double>>, "
             "asks array<struct<px:double,sz:double>>")
ORDER = ["recv_ns", "seq", "event_no"]


def _update(side: Column, px: Column, qty: Column) -> Column:
    return F.struct(side.alias("side"), px.try_cast("double").alias("px"), qty.try_cast("double").alias("qty"))


def coinbase_level_events(frames: DataFrame) -> DataFrame:
    updates = F.transform("ev.updates", lambda u: _update(
        F.when(u["side"] == "bid", "bid").when(u["side"] == "offer", "ask"), u["price_level"], u["new_quantity"]))
    return coinbase_events(frames, "l2_data").select(
        canonical_of(F.col("ev.product_id"), "coinbase").alias("symbol"), "recv_ns", "seq",
        F.col("event_no").cast("int").alias("event_no"), F.lit(False).alias("clear"),
        updates.alias("updates")).where(F.col("symbol").isNotNull())


def kraken_level_events(frames: DataFrame) -> DataFrame:
    """A snapshot message clears both sides first."""
    sides = "array<struct<price:string,qty:string>>"
    df = of_venue(frames, "kraken", channel="string", type="string",
                  data=f"array<struct<symbol:string,bids:{sides},asks:{sides}>>")
    df = df.where(msg("channel") == "book").withColumn("_list", msg("data")).select(
        "*", F.posexplode("_list").alias("event_no", "t"))

    def side(key: str, name: str) -> Column:
        levels = F.coalesce(F.col("t")[key], F.array().cast(sides))
        return F.transform(levels, lambda u: _update(F.lit(name), u["price"], u["qty"]))

    return df.select(kraken_symbol(F.col("t")["symbol"]).alias("symbol"), "recv_ns", "seq",
                     F.col("event_no").cast("int").alias("event_no"),
                     F.coalesce(msg("type") == "snapshot", F.lit(False)).alias("clear"),
                     F.concat(side("bids", "bid"), side("asks", "ask")).alias("updates")).where(
        F.col("symbol").isNotNull())


# ---- replay of one ordered run of events ----

def best_levels(levels: dict[float, float], depth: int, highest: bool) -> list[dict]:
    """The ``depth`` best prices of one side, best first, without sorting the rest."""
    pick = heapq.nlargest if highest else heapq.nsmallest
    return [{"px": px, "sz": levels[px]} for px in pick(depth, levels)]


def apply_updates(book: dict[str, dict[float, float]], updates) -> None:
    """Set the quantity of each priced level of a known side; quantity 0 takes the level out."""
    for side, px, qty in ((u["side"], u["px"], u["qty"]) for u in updates):
        if side in book and px is not None and qty is not None:
            book[side][px] = qty
            if not qty:
                del book[side][px]


def replay(book: dict[str, dict[float, float]], last_emit: int, events, depth: int) -> tuple[list[dict], int]:
    """Apply (recv_ns, clear, updates) events to ``book`` in place; returns due snapshots."""
    snapshots = []
    for recv_ns, clear, updates in events:
        if clear:
            for levels in book.values():
                levels.clear()
        if updates is not None:
            apply_updates(book, updates)
        if recv_ns < last_emit + EMIT_EVERY_NS:
            continue
        last_emit = recv_ns
        snapshots.append({"ts_ns": recv_ns, "bids": best_levels(book["bid"], depth, True),
                          "asks": best_levels(book["ask"], depth, False)})
    return snapshots, last_emit


def _ordered_events(pdf: pd.DataFrame):
    pdf = pdf.sort_values(ORDER, kind="stable")
    return zip(pdf["recv_ns"].tolist(), pdf["clear"].tolist(), pdf["updates"].tolist(), strict=True)


# ---- emission times ----

def chain_ends(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of the sorted times: the index of the emission after it (past the end: none), and of the last one that
    follows from it."""
    n = len(t)
    following = np.searchsorted(t, t + EMIT_EVERY_NS)
    last, jump = np.arange(n), following.copy()
    while (open_ := jump < n).any():  # doubling: each round skips twice as many emissions
        last[open_] = last[jump[open_]]
        jump[open_] = jump[jump[open_]]
    return following, last


def _exits(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """(entry, last): an emission falling due at or before ``entry`` makes ``last`` the cell's last one."""
    symbol, cell = key
    t = np.sort(pdf["recv_ns"].to_numpy())
    last = t[chain_ends(t)[1]]
    # a due time reaches at most one interval past the cell's first message
    reach = min(int(np.searchsorted(t, t[0] + EMIT_EVERY_NS)) + 1, len(t))
    t, last = t[:reach], last[:reach]
    keep = np.append(last[1:] != last[:-1], True)
    return pd.DataFrame({"symbol": symbol, "cell": cell, "entry_ns": t[keep], "last_ns": last[keep]})


def _walk(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """Last emission before each cell of a symbol, from the cells' exit reports."""
    rows, last = [], 0
    for cell, reports in pdf.sort_values(["cell", "entry_ns"]).groupby("cell", sort=True):
        rows.append((key[0], cell, last))
        hit = reports[reports["entry_ns"] >= last + EMIT_EVERY_NS]
        if len(hit):
            last = int(hit["last_ns"].iloc[0])
    return pd.DataFrame(rows, columns=["symbol", "cell", "last_emit"])


def _emissions(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    """All emission times of a cell."""
    t, out = np.sort(pdf["recv_ns"].to_numpy()), []
    following = chain_ends(t)[0]
    at = int(np.searchsorted(t, int(pdf["last_emit"].iloc[0]) + EMIT_EVERY_NS))
    while at < len(t):
        out.append(t[at])
        at = int(following[at])
    return pd.DataFrame({"symbol": key[0], "emit_ns": np.array(out, np.int64)})


def emission_times(events: DataFrame, cell_ns: int = MINUTE) -> DataFrame:
    """``symbol, emit_ns``: when a book is due, from the receive times alone.

    Cells of time report in parallel where an emission due at their start would lead; a walk over the reports, one
    task per symbol and few rows per cell, says how each cell begins. A task holds the distinct receive times of a cell.
    """
    times = events.select("symbol", "recv_ns").distinct().withColumn("cell", idiv(F.col("recv_ns"), cell_ns))
    exits = times.groupBy("symbol", "cell").applyInPandas(_exits, "symbol string, cell long, entry_ns long, last_ns long")
    starts = exits.groupBy("symbol").applyInPandas(_walk, "symbol string, cell long, last_emit long")
    return times.join(starts, ["symbol", "cell"]).groupBy("symbol", "cell").applyInPandas(
        _emissions, "symbol string, emit_ns long")


# ---- blocks of events ----

def event_blocks(events: DataFrame, depth: int) -> DataFrame:
    """Blocks of each symbol, numbered 1.. in order, as ``symbol, idx`` with their time range, their last and the next
    clearing, and the levels per side that their start can bring to the top: the depth and one more per deletion."""
    per = Window.partitionBy("symbol").orderBy("idx")  # blocks hold many events, so these are few rows

    def deleted(side: str) -> Column:
        gone = F.filter("updates", lambda u: (u["side"] == side) & (u["qty"] == 0))
        return F.coalesce(F.sum(F.when(F.col("updates").isNotNull(), F.size(gone))), F.lit(0))

    blocks = events.groupBy("symbol", "idx").agg(
        F.min("recv_ns").alias("first_ns"), F.max("recv_ns").alias("until_ns"),
        F.max(F.when(F.col("clear"), F.struct(*ORDER))).alias("last_clear"),
        *((deleted(s) + depth).alias(f"{s}_need") for s in SIDES))
    return (blocks.withColumn("next_clear", F.first(F.when(F.col("last_clear").isNotNull(), F.col("idx")), ignorenulls=True)
                              .over(per.rowsBetween(1, Window.unboundedFollowing)))
            .withColumn("before_ns", F.lag("until_ns").over(per))
            .withColumn("n_blocks", F.count(F.lit(1)).over(Window.partitionBy("symbol"))))


def last_emissions(blocks: DataFrame, emissions: DataFrame) -> DataFrame:
    """``symbol, idx, last_emit``: the last emission before each block, 0 if there is none."""
    both = (emissions.select("symbol", F.col("emit_ns").alias("at"), F.lit(None).cast("long").alias("idx"), "emit_ns")
            .unionByName(blocks.select("symbol", F.coalesce("before_ns", F.lit(-1)).alias("at"), "idx",
                                       F.lit(None).cast("long").alias("emit_ns"))))
    upto = Window.partitionBy("symbol").orderBy("at", F.col("idx").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    return (both.withColumn("last_emit", F.coalesce(F.max("emit_ns").over(upto), F.lit(0))).where("idx is not null")
            .select("symbol", "idx", "last_emit"))


def tree_nodes(first: str, last: str, size: str) -> Column:
    """The few nodes ``(height, no)`` of a binary tree over block numbers that make up ``first..last`` exactly."""
    return F.expr(f"""flatten(transform(sequence(0, cast(ceil(log2({size} + 2)) as int)), k -> filter(array(
        case when shiftright({first} + shiftleft(1L, k) - 1, k) < shiftright({last} + 1, k)
                  and shiftright({first} + shiftleft(1L, k) - 1, k) % 2 = 1
             then struct(k as height, shiftright({first} + shiftleft(1L, k) - 1, k) as no) end,
        case when shiftright({first} + shiftleft(1L, k) - 1, k) < shiftright({last} + 1, k)
                  and shiftright({last} + 1, k) % 2 = 1
             then struct(k as height, shiftright({last} + 1, k) - 1 as no) end), x -> x is not null)))""")


def levels_at_start(events: DataFrame, blocks: DataFrame) -> DataFrame:
    """(symbol, idx, side, px, qty): the levels alive when block ``idx`` begins that can come to the top within it.

    A level lives from the block after its last update until the block that updates or clears it. That span is a few
    nodes of a tree over the blocks, so a level that rests for long is no row per block; a node keeps its best levels
    only, as many as the neediest block below can use. What leaves here is bounded by events times the tree's height.
    """
    order = F.struct(*ORDER, "i")
    known = blocks.select("symbol", "idx", "last_clear", "next_clear", "n_blocks")
    changes = (events.select("symbol", "idx", *ORDER, "updates").join(known, ["symbol", "idx"])
               .select("symbol", "idx", *ORDER, "last_clear", "next_clear", "n_blocks", F.posexplode("updates").alias("i", "u"))
               .where(F.col("last_clear").isNull() | (F.struct(*ORDER) >= F.col("last_clear")))
               .where("u.side is not null and u.px is not null and u.qty is not null")
               .groupBy("symbol", "idx", F.col("u.side").alias("side"), F.col("u.px").alias("px"))
               .agg(F.max_by("u.qty", order).alias("qty"), F.first("next_clear").alias("next_clear"),
                    F.first("n_blocks").alias("n_blocks")))
    level = Window.partitionBy("symbol", "side", "px").orderBy("idx")
    until = F.least(F.lead("idx").over(level), F.col("next_clear"), F.col("n_blocks"))
    spans = (changes.withColumn("until", until).where((F.col("qty") != 0) & (F.col("until") > F.col("idx")))
             .withColumn("since", F.col("idx") + 1))
    node = ["symbol", "side", "height", "no"]
    resting = spans.select("symbol", "side", "px", "qty", F.explode(tree_nodes("since", "until", "n_blocks")).alias("x")
                           ).select("symbol", "side", "px", "qty", "x.*")
    above = (blocks.select("symbol", "idx", F.explode(F.array(*(F.struct(F.lit(s).alias("side"), F.col(f"{s}_need").alias("need"))
                                                               for s in SIDES))).alias("x"),
                           F.expr("sequence(0, cast(ceil(log2(n_blocks + 2)) as int))").alias("heights"))
             .select("symbol", "idx", "x.*", F.explode("heights").alias("height"))
             .withColumn("no", F.expr("shiftright(idx, height)")))
    best_first = F.when(F.col("side") == "bid", -F.col("px")).otherwise(F.col("px"))
    top = (resting.withColumn("rank", F.row_number().over(Window.partitionBy(*node).orderBy(best_first)))
           .join(above.groupBy(*node).agg(F.max("need").alias("most")), node).where("rank <= most"))
    return top.join(above, node).where("rank <= need").select("symbol", "idx", "side", "px", "qty")


def rebuild_books(events: DataFrame, venue: str, depth: int = 20, block_events: int = 1 << 15) -> DataFrame:
    """Snapshots of all symbols from their level events; events are sorted once, into a scratch copy."""
    spark = events.sparkSession
    events = materialize(sorted_blocks(events, ["symbol"], ORDER), shared_dir(spark, "sorted-events"))
    events = ranked(events, ["symbol"]).withColumn("idx", idiv(F.col("rank"), block_events) + 1).drop("block", "rank", "n")
    blocks = event_blocks(events, depth)
    blocks = materialize(blocks, shared_dir(spark, "event-blocks"))
    starts = last_emissions(blocks, emission_times(events))
    runs = events.select("symbol", "idx", *ORDER, "clear", "updates").join(starts, ["symbol", "idx"])

    def run(key: tuple, pdf: pd.DataFrame, alive: pd.DataFrame) -> pd.DataFrame:
        book: dict = {side: {} for side in SIDES}
        for side, px, qty in zip(alive["side"], alive["px"], alive["qty"], strict=True):
            if side in book:
                book[side][px] = qty
        if not len(pdf):
            return pd.DataFrame({"ts_ns": [], "symbol": [], "bids": [], "asks": []})
        found, _ = replay(book, int(pdf["last_emit"].iloc[0]), _ordered_events(pdf), depth)
        return pd.DataFrame([{"symbol": key[0], **s} for s in found], columns=["ts_ns", "symbol", "bids", "asks"])

    alive_at = levels_at_start(events, blocks).withColumnsRenamed({"symbol": "of_symbol", "idx": "of_idx"})
    books = (runs.groupBy("symbol", "idx").cogroup(alive_at.groupBy("of_symbol", "of_idx"))
             .applyInPandas(run, SNAPSHOTS))
    return book_rows(books, venue, depth)


def book_rows(books: DataFrame, venue: str, depth: int) -> DataFrame:
    values = {"recv_ns": F.col("ts_ns"), "venue": F.lit(venue), "depth": F.lit(depth),
              "ingested_at_ns": F.unix_micros(F.current_timestamp()) * 1000}
    return books.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
                          for f in SCHEMAS["book_l2_snapshot"].fields])


# ---- the same replay as a stateful stream ----

#: Rows of a trigger that are Python objects at one time.
SLICE_ROWS = 8_192


def gathered(rows: Iterator[pd.DataFrame], columns: dict[str, type | None]) -> dict[str, np.ndarray]:
    """Columns of a trigger's rows as flat numbers; a column given a type holds a list of them per row, laid end to end."""
    parts: dict[str, list[np.ndarray]] = {c: [] for c in columns}
    for pdf in rows:
        for c, kind in columns.items():
            parts[c].append(pdf[c].to_numpy() if kind is None else
                            np.concatenate([np.empty(0, kind), *(np.asarray(x, kind) for x in pdf[c])]))
    return {c: np.concatenate(parts.pop(c)) for c in columns}


def flat_updates(events: DataFrame) -> DataFrame:
    """Level events with their applicable updates as lists of plain values."""
    known = F.coalesce(F.filter("updates", lambda u: u["side"].isin(*SIDES) & u["px"].isNotNull() & u["qty"].isNotNull()),
                       F.array().cast(events.schema["updates"].dataType))
    return events.withColumn("updates", known).select(
        "symbol", *ORDER, "clear", F.size("updates").alias("n"),
        F.transform("updates", lambda u: u["side"] == SIDES[0]).alias("bid"),
        F.col("updates.px").alias("px"), F.col("updates.qty").alias("qty"))


def flat_events(rows: Iterator[pd.DataFrame]) -> Iterator[Iterator[tuple]]:
    """The rows of ``flat_updates`` in order, in slices of (recv_ns, clear, updates). All of them are held as numbers
    only, under a hundred bytes an event; a slice at a time is Python objects."""
    x = gathered(rows, {**dict.fromkeys([*ORDER, "clear", "n"]), "bid": bool, "px": float, "qty": float})
    order = np.lexsort([x.pop(c) for c in ORDER[:0:-1]] + [x["recv_ns"]])
    until = np.cumsum(x["n"])

    def updates(i: int) -> list[dict]:
        at = slice(until[i] - x["n"][i], until[i])
        return [{"side": SIDES[0] if bid else SIDES[1], "px": px, "qty": qty}
                for bid, px, qty in zip(x["bid"][at].tolist(), x["px"][at].tolist(), x["qty"][at].tolist())]

    for first in range(0, len(order), SLICE_ROWS):
        at = order[first:first + SLICE_ROWS]
        yield zip(x["recv_ns"][at].tolist(), x["clear"][at].tolist(), map(updates, at.tolist()), strict=True)


class TrackedBook:
    """A book over keyed state that remembers which levels changed."""

    def __init__(self, levels: Iterator):
        self.sides: dict[str, dict[float, float]] = {side: {} for side in SIDES}
        for (side, px), (qty,) in levels:
            self.sides[side][px] = qty
        self.stored = {side: dict(found) for side, found in self.sides.items()}

    def changes(self) -> Iterator[tuple[str, float, float | None]]:
        """Levels to set, and with None those to remove, since the state was read."""
        for side in SIDES:
            now, before = self.sides[side], self.stored[side]
            yield from ((side, px, qty) for px, qty in now.items() if before.get(px) != qty)
            yield from ((side, px, None) for px in before if px not in now)


class BookStream(StatefulProcessor):
    """Live levels as map state, one entry per price level, and the last emission; both outlive reconnects.

    A trigger writes the entries of levels it changed. Rows of a trigger come in any order and are sorted as flat numbers;
    updates and snapshots are Python objects a slice at a time. What a trigger takes in is bounded at the source
    (``maxFilesPerTrigger`` or ``maxBytesPerTrigger``), also for a backlog.
    """

    def __init__(self, depth: int):
        self.depth = depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.levels = handle.getMapState("levels", "side string, px double", "qty double")
        self.last = handle.getValueState("last", "emit_ns long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        book = TrackedBook(self.levels.iterator())
        last = self.last.get()[0] if self.last.exists() else 0
        for events in flat_events(rows):
            found, last = replay(book.sides, last, events, self.depth)
            yield pd.DataFrame([{"symbol": key[0], **s} for s in found], columns=["ts_ns", "symbol", "bids", "asks"])
        for side, px, qty in book.changes():
            if qty is None:
                self.levels.removeKey((side, px))
            else:
                self.levels.updateValue((side, px), (qty,))
        self.last.update((last,))

    def close(self) -> None:
        pass


def stream_books(events: DataFrame, venue: str, depth: int = 20) -> DataFrame:
    """Books of a stream of level events; needs the session's state store to be one that can hold maps (RocksDB)."""
    books = flat_updates(events).groupBy("symbol").transformWithStateInPandas(BookStream(depth), SNAPSHOTS, "Append", "None")
    return book_rows(books, venue, depth)


def rebuild_from_frames(venue: str):
    """The parser form of the rebuild: landed messages of a venue → snapshots. Messages are decoded once, into a scratch
    copy, since the rebuild reads the events several times."""
    def parse(frames: DataFrame, depth: int = 20, **options) -> DataFrame:
        events = LEVEL_EVENTS[venue](frames)
        return rebuild_books(materialize(events, shared_dir(frames.sparkSession, "level-events")), venue, depth, **options)

    return parse


LEVEL_EVENTS = {"coinbase": coinbase_level_events, "kraken": kraken_level_events}
__all__ = ["LEVEL_EVENTS", "rebuild_books", "rebuild_from_frames", "stream_books"]
