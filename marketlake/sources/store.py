"""Partitioned Parquet tables: scan, views, append, published batches, compaction, metadata log."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.timeutil import date_of, hour_bucket
from marketlake.schemas import META_KEYS, META_SCHEMAS, SCHEMAS, conform, schema_for
from marketlake.session import settings, shared_dir
from marketlake.sources.arrival import POSITION, POSITION_TYPE, position, with_position

PARTITION = ("symbol", "venue", "date")
# Encoding and rotation of stored files.
ZSTD_LEVEL = 6
ROWS_PER_FILE = 50_000
#: Files that are moved or deleted at a time.
MOVES_AT_ONCE = 16

#: Tags of compactions in a table's log.
COMPACTION = "compact-"
FILE_LISTING = ("path string, modificationTime timestamp, length long, content binary, "
                "symbol string, venue string, date string")
#: Stored next to every row: when its append ran and its position in what was appended. Their order is the order of
#: arrival; files without a stamp come first, by file and row.
ARRIVAL = ("appended_ns", POSITION)
STAMP = (T.StructField("appended_ns", T.LongType()), T.StructField(POSITION, POSITION_TYPE))


def with_arrival(df: DataFrame) -> DataFrame:
    """Give a scan of stored files its order of arrival, whatever order the files were sorted in."""
    filed = position(0, F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return df.withColumns({POSITION: F.coalesce(POSITION, filed), "appended_ns": F.coalesce("appended_ns", F.lit(0).cast("long"))})


class Files:
    """The few file-system calls that tables need, on whatever store holds them."""

    def __init__(self, spark: SparkSession, base: str):
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # looked up once: each name on the way is a call
        self.fs = self.path(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def data_files(self, folder: str) -> list[str]:
        """Paths below a folder of the data files a write has left there, listed folder by folder: a recursive listing of
        a local store asks for each file's owner by a process of its own."""
        out, folders = [], [self.path(folder)]
        while folders:
            for x in self.fs.listStatus(folders.pop()):
                at = x.getPath()
                if x.isDirectory():
                    folders.append(at)
                elif not at.getName().startswith(("_", ".")):
                    out.append(at.toString())
        return sorted(out)

    def sizes(self, folder: str) -> dict[str, int]:
        """Data files of one folder and their bytes."""
        found = self.fs.listStatus(self.path(folder)) if self.exists(folder) else []
        return {x.getPath().toString(): x.getLen() for x in found
                if x.isFile() and not x.getPath().getName().startswith(("_", "."))}

    def children(self, folder: str) -> list[str]:
        return sorted(x.getPath().toString() for x in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def move(self, source: str, target: str) -> None:
        """Move a file; a move that somebody else has made meanwhile is no fault."""
        self.fs.mkdirs(self.path(target).getParent())
        try:
            moved = self.fs.rename(self.path(source), self.path(target))
        except Py4JJavaError:  # some stores raise, others say False
            moved = False
        if not moved and (self.exists(source) or not self.exists(target)):
            raise OSError(f"cannot move {source} to {target}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.path(name), True)

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.path(name), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, name: str) -> str:
        source = self.fs.open(self.path(name))
        try:
            return bytes(source.readAllBytes()).decode()
        finally:
            source.close()


class Lake:
    """Tables under one base folder: ``raw/`` and ``derived/`` data, ``meta/`` logs."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, table: str) -> str:
        if table in META_SCHEMAS:
            return f"{self.base}/meta/{table}"
        schema_for(table)
        return f"{self.base}/{'derived' if table.startswith('bars') else 'raw'}/{table}"

    # ---- scans ----

    def read_or_none(self, path: str, schema: T.StructType, form: str = "parquet") -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).format(form).load(path)
        except AnalysisException as err:
            if "PATH_NOT_FOUND" in str(err):
                return None
            raise

    def _stored(self, table: str) -> tuple[DataFrame | None, T.StructType]:
        # date stays a string; given schemas null-fill columns an old file lacks
        schema = T.StructType([*schema_for(table).fields, T.StructField("date", T.StringType()),
                               *STAMP])
        return self.read_or_none(self.path(table), schema), schema

    def table(self, table: str) -> DataFrame:
        """A stored table with its ``date``; a table nobody wrote yet is empty, not an error."""
        found, schema = self._stored(table)
        return (found if found is not None else self.spark.createDataFrame([], schema)).drop(*ARRIVAL)

    def arrivals(self, table: str) -> DataFrame:
        """The stored table with the columns of ``ARRIVAL``."""
        found, schema = self._stored(table)
        if found is None:
            return self.spark.createDataFrame([], schema)
        return with_arrival(found)

    def exists(self, table: str) -> bool:
        return self._stored(table)[0] is not None

    def register_views(self) -> list[str]:
        """One temp view per table and metadata table, for ad-hoc SQL."""
        for name in SCHEMAS:
            self.table(name).createOrReplaceTempView(name)
        for name in META_SCHEMAS:
            self.meta(name).createOrReplaceTempView(name)
        return [*SCHEMAS, *META_SCHEMAS]

    def sql(self, text: str, **args) -> DataFrame:
        self.register_views()
        return self.spark.sql(text, args=args or None)

    # ---- sinks ----

    def _laid_out(self, table: str, rows: DataFrame, order: str | None) -> DataFrame:
        """Declared columns, stamp and date, dealt by feed and hour and sorted by time.

        The position of a row is the one it carries from its message, or its file and row, taken before anything is
        shuffled, or what its ``order`` column says. The rebalance lets adaptive execution split a feed that holds
        most of the rows and merge the small ones; sorting by time keeps row-group ranges tight.
        """
        if order is None and table.startswith("bars"):
            order = "ts_ns"  # computed rows have no order of arrival but time
        names = schema_for(table).fieldNames()
        out = (conform(with_position(rows, order), table, extra=[POSITION])
               .withColumns({"appended_ns": F.lit(time.time_ns()), "date": date_of("ts_ns"), "_hour": hour_bucket("ts_ns")}))
        return (out.hint("rebalance", F.col("symbol"), F.col("venue"), F.col("date"), F.col("_hour"))
                .sortWithinPartitions(*PARTITION, "_hour", "ts_ns", POSITION).select(*names, *ARRIVAL, "date"))

    def append(self, table: str, rows: DataFrame, records_per_file: int | None = None, order: str | None = None) -> None:
        """Append without overwriting or deduplicating, one file per feed and hour."""
        write_parquet(self._laid_out(table, rows, order), self.path(table), records_per_file)

    def append_once(self, table: str, rows: DataFrame, tag: str, order: str | None = None) -> bool:
        """Append under a name: done at most once however often it is retried. False if it was done before.

        The files are staged beside the table, then moved in under names that a log lists beforehand, so
        a retry goes on where the last attempt stopped. Readers see plain table files.
        """
        if self._published(table, tag):
            return False
        staging = f"{self.path(table)}/_staged/{tag}"
        write_parquet(self._laid_out(table, rows, order), staging, ROWS_PER_FILE, mode="overwrite")
        self._publish(table, staging, tag, [])
        return True

    def _log(self, table: str, tag: str) -> str:
        return f"{self.path(table)}/_log/{tag}"

    def _published(self, table: str, tag: str) -> bool:
        """Whether a batch is in the table; a half-done one is finished first."""
        files, log = Files(self.spark, self.base), self._log(table, tag)
        if files.exists(f"{log}.planned"):
            self._carry_out(files, table, tag)
        return files.exists(f"{log}.done")

    def _publish(self, table: str, staging: str, tag: str, remove: list[str]) -> None:
        files, top = Files(self.spark, self.base), files_root(staging)
        moves = []
        for i, source in enumerate(files.data_files(staging)):
            inner = source[source.index(top) + len(top):].rpartition("/")[0]
            moves.append([source, f"{self.path(table)}{inner}/{tag}-{i:05d}.parquet"])
        files.write(f"{self._log(table, tag)}.planned", json.dumps({"moves": moves, "remove": remove, "staging": staging}))
        self._carry_out(files, table, tag)

    def _carry_out(self, files: Files, table: str, tag: str) -> None:
        """Bring a planned batch to its end; every step can be repeated."""
        log = self._log(table, tag)
        try:
            plan = json.loads(files.read(f"{log}.planned"))
        except Py4JJavaError:
            if files.exists(f"{log}.done"):
                return  # brought to its end by another run in this moment
            raise

        def move(source: str, target: str) -> None:
            if files.exists(source) and not files.exists(target):
                files.move(source, target)

        with ThreadPoolExecutor(MOVES_AT_ONCE) as pool:  # a store answers many calls at once; the first fault is raised
            list(pool.map(move, *zip(*plan["moves"])) if plan["moves"] else ())
            list(pool.map(files.delete, plan["remove"]))
        files.delete(plan["staging"])
        files.move(f"{log}.planned", f"{log}.done")

    def forget(self, table: str, tag: str) -> None:
        """Drop the log of a batch that can no longer be retried."""
        Files(self.spark, self.base).delete(f"{self._log(table, tag)}.done")

    def land_klines(self, klines: DataFrame, interval: str = "1m") -> None:
        """Klines → bars_ref: constant interval, unknown ingest time."""
        self.append("bars_ref", klines.withColumn("interval", F.lit(interval))
                    .withColumn("ingested_at_ns", F.lit(None).cast("long")))

    def spans(self, table: str) -> DataFrame:
        """Rows, first and last ``ts_ns`` of each partition, from the footers of the files: no page of data is read.

        Counts and extremes are pushed into the footers by the second-generation reader only, hence the settings. The
        result, a row per partition, is stored while they hold.
        """
        schema = T.StructType([f for f in self._stored(table)[1] if f.name in ("ts_ns", *PARTITION)])
        with settings(self.spark, spark__sql__sources__useV1SourceList="", spark__sql__parquet__aggregatePushdown="true"):
            return self.materialize(footer_spans(self.read_or_none(self.path(table), schema)), shared_dir(self.spark, "spans"))

    # ---- compaction ----

    def files(self, table: str) -> DataFrame:
        """One row per data file: partition, path, size and number of files in the partition.

        Listed from the store's metadata; no row is read.
        """
        empty = self.spark.createDataFrame([], "symbol string, venue string, date string, file string, bytes long, n_files long")
        folders = Files(self.spark, self.base).children(self.path(table))
        if not any(f"/{PARTITION[0]}=" in name for name in folders):  # nothing but logs and staged files, if anything
            return empty
        # this source reads no content when only path and length are asked for
        listed = self.spark.read.format("binaryFile").schema(FILE_LISTING).load(self.path(table))
        return (listed.select(*PARTITION, F.col("path").alias("file"), F.col("length").alias("bytes"))
                .withColumn("n_files", F.count(F.lit(1)).over(Window.partitionBy(*PARTITION))))

    def compact(self, table: str, target_bytes: int = 1 << 30, most_files: int = 10_000) -> int:
        """Merge small files of each partition into files of up to ``target_bytes``; returns files merged.

        Only files below half the target are touched, in groups of at least two, so a second run finds nothing to do.
        The files of a run are listed once; rows appended meanwhile are other files and stay. Merged files are
        staged, then exactly the listed ones are replaced, by a log that a later run finishes after a crash.
        A run takes ``most_files`` at most, whole groups each; call again for the rest.
        """
        files = Files(self.spark, self.base)
        for planned in files.children(f"{self.path(table)}/_log"):
            tag = planned.rpartition("/")[2].removesuffix(".planned")
            if planned.endswith(".planned") and tag.startswith(COMPACTION):  # batches of streams are theirs to finish
                self._carry_out(files, table, tag)
        in_order = Window.partitionBy(*PARTITION).orderBy("file")  # the files of one partition
        before = F.coalesce(F.sum("bytes").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        small = self.files(table).where(F.col("bytes") * 2 < target_bytes).withColumn(
            "part", F.floor(before / F.lit(target_bytes)).cast("long"))
        group = Window.partitionBy(*PARTITION, "part")
        many = (small.withColumn("n", F.count(F.lit(1)).over(group)).where("n > 1")
                .orderBy(*PARTITION, "part", "file").limit(most_files))
        chosen = [r.asDict() for r in many.select(*PARTITION, "part", "n", "file").collect()]
        groups: dict[tuple, list[str]] = {}
        for r in chosen:
            groups.setdefault((*[r[c] for c in PARTITION], r["part"]), []).append(r["file"])
        if chosen and len(groups) > 1 and len(groups[last := next(reversed(groups))]) < chosen[-1]["n"]:
            del groups[last]  # cut by the limit: left to the next run
        listed = [f for names in groups.values() for f in names]
        if not listed:
            return 0
        # one task writes the files of a partition's parts under equal names: partition and name tell a file
        part = self.spark.createDataFrame(
            [(*key[:3], f.rpartition("/")[2], i) for i, (key, names) in enumerate(groups.items()) for f in names],
            "symbol string, venue string, date string, _file string, _group int")
        schema = self._stored(table)[1]
        rows = (self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*listed)
                .select("*", F.col("_metadata.file_name").alias("_file")))
        tag = f"{COMPACTION}{uuid.uuid4().hex[:12]}"
        staging = f"{self.path(table)}/_staged/{tag}"
        merged = (rows.join(F.broadcast(part), [*PARTITION, "_file"]).repartition(len(groups), "_group")  # at most `most_files` rows
                  .sortWithinPartitions("_group", "ts_ns", *ARRIVAL).drop("_file", "_group"))
        write_parquet(merged, staging)
        self._publish(table, staging, tag, listed)
        self.forget(table, tag)
        return len(listed)

    # ---- metadata: an append-only log, latest write of a key wins ----

    def meta_log(self, name: str) -> DataFrame:
        schema = T.StructType([*META_SCHEMAS[name].fields, T.StructField("written_ns", T.LongType())])
        found = self.read_or_none(self.path(name), schema)
        return found if found is not None else self.spark.createDataFrame([], schema)

    def meta(self, name: str) -> DataFrame:
        return latest_by_key(self.meta_log(name), META_KEYS[name], "written_ns").select(
            *META_SCHEMAS[name].fieldNames())

    def put_meta(self, name: str, rows: DataFrame, replace: bool = False) -> None:
        """Insert-or-replace by key; ``replace`` swaps the whole table."""
        out = conform(rows, name).withColumn("written_ns", F.lit(time.time_ns()))
        out.write.mode("overwrite" if replace else "append").option("compression", "zstd").parquet(self.path(name))

    def compact_log(self, name: str, target_bytes: int = 128 << 20, least: int = 16) -> int:
        """Merge the small files of a metadata log once there are ``least`` of them; returns files merged.

        Of the merged rows the latest of each key stays. The swap is logged like that of a table's compaction.
        """
        files, path = Files(self.spark, self.base), self.path(name)
        for planned in files.children(f"{path}/_log"):
            tag = planned.rpartition("/")[2].removesuffix(".planned")
            if planned.endswith(".planned") and tag.startswith(COMPACTION):
                self._carry_out(files, name, tag)
        sizes = files.sizes(path)
        small = sorted(f for f, size in sizes.items() if size * 2 < target_bytes)
        if len(small) < least:
            return 0
        log = T.StructType([*META_SCHEMAS[name].fields, T.StructField("written_ns", T.LongType())])
        rows = latest_by_key(self.spark.read.schema(log).parquet(*small), META_KEYS[name], "written_ns")
        tag = f"{COMPACTION}{uuid.uuid4().hex[:12]}"
        staging = f"{path}/_staged/{tag}"
        merged = -(-sum(sizes[f] for f in small) // target_bytes)
        rows.coalesce(merged).write.option("compression", "zstd").parquet(staging)
        self._publish(name, staging, tag, small)
        self.forget(name, tag)
        return len(small)

    def materialize(self, rows: DataFrame, path: str) -> DataFrame:
        return materialize(rows, path)


def footer_spans(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PARTITION).agg(F.count(F.lit(1)).alias("rows"), F.min("ts_ns").alias("first_ts_ns"),
                                        F.max("ts_ns").alias("last_ts_ns"))


def latest_by_key(log: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Newest row per key; merges map-side, so the length of a key's history does not matter."""
    rest = [c for c in log.columns if c not in keys]
    return (log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]))


def encoding() -> dict[str, str]:
    return {"compression": "zstd", "parquet.compression.codec.zstd.level": str(ZSTD_LEVEL),
            "parquet.enable.dictionary": "true"}


def files_root(folder: str) -> str:
    """A folder's path without scheme and host, as it stands inside full file names."""
    return folder if "://" not in folder else "/" + folder.split("://", 1)[1].partition("/")[2]


def write_parquet(rows: DataFrame, path: str, records_per_file: int | None = None, mode: str = "append") -> None:
    writer = rows.write.mode(mode).options(**encoding()).partitionBy(*PARTITION)
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.parquet(path)


def materialize(rows: DataFrame, path: str) -> DataFrame:
    """Write once to a shared folder and read back, where several jobs need the rows."""
    rows.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
