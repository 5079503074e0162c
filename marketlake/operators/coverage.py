"""What is stored: rows, time span and bytes per partition, and roll-ups of that."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions.timeutil import SECOND, idiv
from marketlake.sources.store import footer_spans
from marketlake.sources.venues import known_venue, present_venues

PART = ("symbol", "venue", "date")


def coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per (table, symbol, venue, date), counted."""
    return spanned({n: footer_spans(df) for n, df in tables.items()})


def spanned(spans: dict[str, DataFrame], sizes: DataFrame | None = None) -> DataFrame:
    """Coverage rows from each table's spans. ``sizes``: (table_name, symbol, venue, date, bytes)."""
    rows = reduce(DataFrame.unionByName, [
        df.select(F.lit(n).alias("table_name"), *PART, "rows", "first_ts_ns", "last_ts_ns",
                  idiv(F.col("last_ts_ns") - F.col("first_ts_ns"), SECOND).alias("span_seconds"))
        for n, df in spans.items()])
    if sizes is None:
        return rows.withColumn("bytes_on_disk", F.lit(0).cast("long"))
    total = sizes.groupBy("table_name", *PART).agg(F.sum("bytes").alias("bytes_on_disk"))
    return rows.join(total, ["table_name", *PART], "left").fillna(0, ["bytes_on_disk"])


def stored_coverage(lake) -> DataFrame:
    """Coverage of every stored table of a lake: counts and spans from footers, bytes from the listing of files."""
    from marketlake.schemas import SCHEMAS
    present = [t for t in SCHEMAS if lake.exists(t)]
    sizes = reduce(DataFrame.unionByName,
                   [lake.files(t).select(F.lit(t).alias("table_name"), *PART, "bytes") for t in present])
    return spanned({t: lake.spans(t) for t in present}, sizes)


def by_table(cov: DataFrame) -> DataFrame:
    return cov.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("rows"), F.sum("bytes_on_disk").alias("bytes"),
        F.count_distinct("symbol").alias("symbols"), F.count_distinct("venue").alias("venues"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def summary(cov: DataFrame) -> DataFrame:
    """One row over the whole lake."""
    return cov.agg(F.count(F.lit(1)).alias("partitions"), F.sum("rows").alias("total_rows"),
                   F.sum("bytes_on_disk").alias("total_bytes"),
                   *[F.array_sort(F.collect_set(c)).alias(f"{c}s") for c in PART])


def matrix(cov: DataFrame, venues: list[str] | None = None) -> DataFrame:
    """Rows per (table, symbol), one column per venue; without a list those present, and no other with one."""
    columns = present_venues(cov) if venues is None else venues
    return (cov.withColumn("venue", known_venue(venues)).groupBy("table_name", "symbol").pivot("venue", columns)
            .agg(F.sum("rows")))


def matrix_markdown(cov: DataFrame, venues: list[str] | None = None) -> DataFrame:
    """The matrix as lines of Markdown, one per (table, symbol), with the header line first."""
    venues = present_venues(cov) if venues is None else venues
    cells = [F.coalesce(F.format_number(F.col(v), 0), F.lit("·")) for v in venues]
    body = matrix(cov, venues).select(
        "table_name", F.lit(1).alias("kind"), "symbol",
        F.concat(F.lit("| "), F.concat_ws(" | ", "symbol", *cells), F.lit(" |")).alias("line"))
    head = cov.select("table_name").distinct().select(
        "table_name", F.lit(0).alias("kind"), F.lit("").alias("symbol"),
        F.lit("| symbol | " + " | ".join(venues) + " |").alias("line"))
    return body.unionByName(head).orderBy("table_name", "kind", "symbol").select("table_name", "symbol", "line")
