"""Streaming bars, tape, health, books, best quotes and the raw sink.

A stream closes a second (or minute) when the watermark passes its end, so results
equal the batch results for everything closed. Rows later than the watermark are
left to the batch rebuild, which appends a newer build of the same bars to the same table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marketlake.functions.timeutil import MINUTE, SECOND, ts_of
from marketlake.operators import health as H
from marketlake.operators import tape as T
from marketlake.operators.bars import bars_from_trades
from marketlake.schemas import BAR_COLUMNS
from marketlake.session import settings
from marketlake.sources.arrival import POSITION, file_position
from marketlake.sources.frames.level2 import SLICE_ROWS, gathered
from marketlake.sources.frames.quotes import gemini_changes, gemini_quotes
from marketlake.sources.store import Lake

# Default lateness and flush interval.
WATERMARK = "5 seconds"
FLUSH = "60 seconds"


def timed(rows: DataFrame, delay: str = WATERMARK, on: str = "ts_ns") -> DataFrame:
    return rows.withColumn("event_time", ts_of(on)).withWatermark("event_time", delay)


def bars_stream(trades: DataFrame, arrival: Sequence[str] = ("seq",), delay: str = WATERMARK) -> DataFrame:
    """Per-venue bars of closed seconds, in append mode."""
    return bars_from_trades(timed(trades, delay), arrival, keys=[F.window("event_time", "1 second")])


def levels_stream(trades: DataFrame, arrival: Sequence[str] = ("seq",), delay: str = WATERMARK) -> DataFrame:
    """Price levels of closed seconds. All levels of a second close in the same batch, so
    that batch can finish the tape with the batch operators."""
    gated = T.gate_trades(T.spot_only(trades))
    levels = T.price_levels(timed(gated, delay), arrival, keys=[F.window("event_time", "1 second")])
    return levels.drop("window")


#: The state store that can hold maps of levels.
MAP_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _start(writer, checkpoint: str, available_now: bool, flush: str = FLUSH) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=flush)).start()


def into_table(rows: DataFrame, lake: Lake, table: str, name: str, checkpoint: str, available_now: bool = False,
               flush: str = FLUSH, finish: Callable[[DataFrame], DataFrame] = lambda batch: batch,
               order: str | None = None) -> StreamingQuery:
    """Every micro-batch into a stored table, once: a retried batch finds its name in the table's log.

    The table stays plain partitioned files, so batch appends, rebuilds, compaction and streams share it. ``name`` tells
    this stream's batches from those of other streams and must stay with its checkpoint.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        lake.append_once(table, finish(batch), f"{name}-{batch_id}", order)
        if batch_id > 1:
            lake.forget(table, f"{name}-{batch_id - 2}")  # only the last batch can come again

    return _start(rows.writeStream.outputMode("append").foreachBatch(write), checkpoint, available_now, flush)


def write_bars(bars: DataFrame, lake: Lake, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    return into_table(bars, lake, "bars_1s", "stream-bars", checkpoint, available_now)


def write_tape(levels: DataFrame, lake: Lake, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Finish the tape of the seconds that a batch closes, with the batch operators."""
    def finish(batch: DataFrame) -> DataFrame:
        return T.roll_levels(T.mark_levels(batch)).where(F.col("n_kept") > 0).select(*BAR_COLUMNS)

    return into_table(levels, lake, "bars_1s", "stream-tape", checkpoint, available_now, finish=finish)


def write_raw(rows: DataFrame, table: str, lake: Lake, checkpoint: str, available_now: bool = False,
              flush: str = FLUSH) -> StreamingQuery:
    """Canonical rows, flushed by time, files bounded by rows. Rows keep the position of their message, or of
    the landed file they are read from."""
    if POSITION not in rows.columns:
        found = file_position(rows)
        rows = rows if found is None else found
    return into_table(rows, lake, table, f"stream-{table}", checkpoint, available_now, flush)


def counts_stream(rows: DataFrame, delay: str = WATERMARK) -> DataFrame:
    """Messages per feed and closed minute, labelled by the minute's end."""
    window = F.window("event_time", "1 minute")
    counts = timed(rows, delay, on="recv_ns").groupBy(window, *H.FEED).agg(F.count(F.lit(1)).alias("n"))
    return counts.select((F.unix_micros("window.end") * 1000).alias("ts_ns"), *H.FEED, "n")


class TrailingRates(StatefulProcessor):
    """Rates of a feed over its last minutes. The state is the counts of the baseline window, one per minute at most."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getValueState("recent", "ts_ns array<long>, n array<long>")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        fresh = pd.concat(list(rows)).sort_values("ts_ns")  # closed minutes of one feed
        held = self.recent.get() if self.recent.exists() else ([], [])
        ts = np.concatenate((np.array(held[0], np.int64), fresh["ts_ns"].to_numpy(np.int64)))
        n = np.concatenate((np.array(held[1], np.int64), fresh["n"].to_numpy(np.int64)))
        upto, at = np.concatenate(([0], np.cumsum(n))), ts[len(held[0]):]

        def rate(window_s: int) -> np.ndarray:
            first = np.searchsorted(ts, at - window_s * SECOND, side="right")
            return (upto[np.searchsorted(ts, at, side="right")] - upto[first]) / float(window_s)

        out = pd.DataFrame({**dict(zip(H.FEED, key)), "ts_ns": at, "recent_per_s": rate(H.RECENT_S),
                            "baseline_per_s": rate(H.BASELINE_S)})
        keep = ts > ts[-1] - H.BASELINE_S * SECOND
        self.recent.update((ts[keep].tolist(), n[keep].tolist()))
        yield out

    def close(self) -> None:
        pass


def health_stream(counts: DataFrame) -> DataFrame:
    """Health of every feed at the end of each closed minute with a message, from keyed state alone."""
    rates = counts.groupBy(*H.FEED).transformWithStateInPandas(
        TrailingRates(), "venue string, symbol string, stream string, ts_ns long, recent_per_s double, baseline_per_s double",
        "Append", "None")
    return H.judged(rates)


def write_health(counts: DataFrame, lake: Lake, checkpoint: str, available_now: bool = False,
                 merge_every: int = 60) -> StreamingQuery:
    """Health of each batch's closed minutes into ``venue_status``.

    A batch reads nothing back, and the table keeps the latest row of a key, so a retried batch doubles nothing. Every
    ``merge_every`` batches the small files of the table are merged.
    """
    def put(batch: DataFrame, batch_id: int) -> None:
        lake.put_meta("venue_status", H.status_rows(batch).coalesce(1))  # a row per feed and minute
        if batch_id % merge_every == merge_every - 1:
            lake.compact_log("venue_status")

    with settings(lake.spark, spark__sql__streaming__stateStore__providerClass=MAP_STORE):
        return _start(health_stream(counts).writeStream.outputMode("append").foreachBatch(put), checkpoint, available_now,
                      f"{MINUTE // SECOND} seconds")


BBO = ("bid_k", "bid_qty", "ask_k", "ask_qty")
BBO_ROWS = f"symbol string, recv_ns long, seq long, {', '.join(f'{c} double' for c in BBO)}"


class BestQuotes(StatefulProcessor):
    """Running best bid and ask, a value of fixed size per symbol; the stream form of the batch prefix maximum.

    Rows of a trigger are sorted as flat numbers and leave in slices.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getValueState("best", ", ".join(f"{c} double" for c in BBO))

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # the running best is the latest row among the largest prices so far: a prefix maximum per side
        x = gathered(rows, dict.fromkeys(["recv_ns", "seq", *BBO]))
        order = np.lexsort((x["seq"], x["recv_ns"]))
        kept = np.array(self.best.get() if self.best.exists() else (None,) * 4, float)
        for first in range(0, len(order), SLICE_ROWS):
            at = order[first:first + SLICE_ROWS]
            out = {"symbol": key[0], "recv_ns": x["recv_ns"][at], "seq": x["seq"][at]}
            for side, held in ((BBO[:2], kept[:2]), (BBO[2:], kept[2:])):
                both = np.vstack((held[None], np.column_stack([x[c][at].astype(float) for c in side])))
                price = np.where(np.isnan(both[:, 0]), -np.inf, both[:, 0])
                top = np.maximum.accumulate(price)
                best = both[np.maximum.accumulate(np.where((price == top) & (price > -np.inf), np.arange(len(both)), 0))]
                held[:] = best[-1]
                out |= dict(zip(side, best[1:].T))
            yield pd.DataFrame(out)
        self.best.update(tuple(None if np.isnan(v) else float(v) for v in kept))

    def close(self) -> None:
        pass


def best_quotes_stream(frames: DataFrame) -> DataFrame:
    """Best quotes of a stream of messages, one per message that follows the first with both sides known."""
    changes = gemini_changes(frames).select("symbol", "recv_ns", "seq",
                                            *[F.col(f"{s}.{f}").alias(f"{s}_{f}") for s in ("bid", "ask")
                                              for f in ("k", "qty")])
    running = changes.groupBy("symbol").transformWithStateInPandas(BestQuotes(), BBO_ROWS, "Append", "None")
    return gemini_quotes(running.withColumns({f"best_{s}": F.struct(F.col(f"{s}_k").alias("k"), F.col(f"{s}_qty").alias("qty"))
                                              for s in ("bid", "ask")}))


def write_books(books: DataFrame, lake: Lake, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    with settings(lake.spark, spark__sql__streaming__stateStore__providerClass=MAP_STORE):
        return into_table(books, lake, "book_l2_snapshot", "stream-books", checkpoint, available_now, order="ts_ns")


def write_quotes(quotes: DataFrame, lake: Lake, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    with settings(lake.spark, spark__sql__streaming__stateStore__providerClass=MAP_STORE):
        return into_table(quotes, lake, "quotes", "stream-quotes", checkpoint, available_now, order="recv_ns")
