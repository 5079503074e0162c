"""Order of arrival as a column that rows carry through shuffles, streams and storage.

A position says where a row came from: the receive time, connection, sequence and place in the message
of a landed message, or file and row of a landed file. Positions compare as structs, so any pair of rows of
one append is ordered without numbering them first, and no row has to stay where it was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.timeutil import MINUTE, idiv

POSITION = "arrival"
POSITION_TYPE = T.StructType([T.StructField("ns", T.LongType()), T.StructField("origin", T.StringType()),
                              T.StructField("row", T.LongType()), T.StructField("event", T.LongType())])
#: Rows of one origin that share a block of an ordered computation.
BLOCK_ROWS = 1 << 20


def position(ns=0, origin="", row=0, event=0) -> Column:
    def column(x) -> Column:
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(column(ns).alias("ns"), column(origin).alias("origin"), column(row).alias("row"),
                    column(event).alias("event")).cast(POSITION_TYPE)


def message_position(frames: DataFrame, event: Column | None = None) -> Column | None:
    """Position of a landed message's rows: by receive time, then connection and sequence, then place in the message."""
    if not {"conn_id", "seq", "recv_ns"} <= set(frames.columns):
        return None
    return position(F.coalesce("recv_ns", F.lit(0)), F.col("conn_id"), F.col("seq"), 0 if event is None else event)


def file_position(rows: DataFrame) -> DataFrame | None:
    """``rows`` with file name and row as their position; None where they are not straight from files.

    Formats that do not count rows within a file are ordered by split start and place in the split.
    """
    hidden = rows._jdf.queryExecution().analyzed().metadataOutput()  # asking for an absent column would log an error
    fields = [a.dataType().catalogString() for a in map(hidden.apply, range(hidden.size())) if a.name() == "_metadata"]
    if len(fields) != 1:
        return None
    row, event = F.col("_metadata.file_block_start"), F.monotonically_increasing_id()
    if "row_index" in fields[0]:
        row, event = F.col("_metadata.row_index"), 0
    return rows.withColumn(POSITION, position(0, F.col("_metadata.file_path"), row, event))


def with_position(rows: DataFrame, order: str | None = None) -> DataFrame:
    """``rows`` with their position: the ``order`` column if named, the position they carry, file and row of a file scan,
    else their place in the partitions, which is the order of local rows and of nothing that was shuffled."""
    if order is not None:
        return rows.withColumn(POSITION, position(row=F.col(order)))
    if POSITION in rows.columns:
        return rows
    found = file_position(rows)
    return found if found is not None else rows.withColumn(POSITION, position(row=F.monotonically_increasing_id()))


def position_block(at: str) -> Column:
    """A value that never falls along positions and cuts them into parts of bounded span: minutes of receipt, or runs of
    rows of a file."""
    p = F.col(at)
    filed = p["ns"] == 0
    return F.struct(idiv(p["ns"], MINUTE).alias("minute"), F.when(filed, p["origin"]).alias("origin"),
                    F.when(filed, idiv(p["row"], BLOCK_ROWS)).alias("run"))
