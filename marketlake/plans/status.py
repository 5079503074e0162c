"""The status report: five roll-ups over the metadata tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.coverage import by_table
from marketlake.operators.health import latest_status
from marketlake.operators.quality import latest_cards
from marketlake.operators.refdata import corrections_rollup
from marketlake.schemas import META_SCHEMAS

ARTEFACTS = ("venue_status", "coverage", "daily_quality", "corrections")


def bars_span(bars: DataFrame) -> DataFrame:
    return bars.agg(F.min("ts_ns").alias("lo"), F.max("ts_ns").alias("hi"), F.count(F.lit(1)).alias("n"))


def write_artefacts(lake, folder: str) -> None:
    """The metadata tables as JSON lines, one folder each, for a report where the tables themselves are not at hand."""
    for name in ARTEFACTS:
        lake.meta(name).write.mode("overwrite").json(f"{folder}/{name}")


def status_report(lake, artefacts: str | None = None) -> dict[str, DataFrame]:
    """Named roll-ups; each stays a DataFrame. A metadata table without rows is taken from the ``artefacts`` of an
    earlier build, if they have it."""
    def known(name: str) -> DataFrame:
        rows = lake.meta(name)
        if artefacts is None or not rows.isEmpty():
            return rows
        found = lake.read_or_none(f"{artefacts}/{name}", META_SCHEMAS[name], "json")
        return rows if found is None else found

    return {"venue_status": latest_status(known("venue_status")),
            "coverage": by_table(known("coverage")),
            "quality": latest_cards(known("daily_quality")),
            "corrections": corrections_rollup(known("corrections")),
            "bars_span": bars_span(lake.table("bars_1s"))}
