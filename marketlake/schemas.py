"""Declared schemas of every table. Readers pass these to Spark, so a column that
an old file lacks comes back null and no footer scan is needed."""

from __future__ import annotations

from pyspark.sql import types as T

LEVELS = T.ArrayType(T.StructType([T.StructField("px", T.DoubleType()),
                                   T.StructField("sz", T.DoubleType())]))

LONG, INT, DOUBLE, STRING = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# Column names, order and types of the stored tables.
SCHEMAS: dict[str, T.StructType] = {
    "trades": _struct(
        ("ts_ns", LONG), ("recv_ns", LONG), ("symbol", STRING), ("venue", STRING), ("price", DOUBLE),
        ("size", DOUBLE), ("side", T.ByteType()), ("trade_id", STRING), ("ingested_at_ns", LONG)),
    "quotes": _struct(
        ("ts_ns", LONG), ("recv_ns", LONG), ("symbol", STRING), ("venue", STRING), ("bid_px", DOUBLE),
        ("ask_px", DOUBLE), ("bid_sz", DOUBLE), ("ask_sz", DOUBLE), ("ingested_at_ns", LONG)),
    "book_l2_snapshot": _struct(
        ("ts_ns", LONG), ("recv_ns", LONG), ("symbol", STRING), ("venue", STRING), ("depth", T.ShortType()),
        ("bids", LEVELS), ("asks", LEVELS), ("ingested_at_ns", LONG)),
    "funding": _struct(
        ("ts_ns", LONG), ("recv_ns", LONG), ("symbol", STRING), ("venue", STRING), ("funding_rate", DOUBLE),
        ("mark_price", DOUBLE), ("next_ts_ns", LONG), ("ingested_at_ns", LONG)),
    "open_interest": _struct(
        ("ts_ns", LONG), ("recv_ns", LONG), ("symbol", STRING), ("venue", STRING), ("oi_base", DOUBLE),
        ("oi_quote", DOUBLE), ("ingested_at_ns", LONG)),
    "bars_1s": _struct(
        ("ts_ns", LONG), ("symbol", STRING), ("venue", STRING), ("open", DOUBLE), ("high", DOUBLE),
        ("low", DOUBLE), ("close", DOUBLE), ("volume", DOUBLE), ("vwap", DOUBLE), ("trades", INT),
        ("sources_mask", INT), ("ingested_at_ns", LONG)),
    "bars_ref": _struct(
        ("ts_ns", LONG), ("symbol", STRING), ("venue", STRING), ("interval", STRING), ("open", DOUBLE),
        ("high", DOUBLE), ("low", DOUBLE), ("close", DOUBLE), ("volume", DOUBLE), ("trades", INT),
        ("ingested_at_ns", LONG)),
}

RAW_TABLES = ("trades", "quotes", "book_l2_snapshot", "funding", "open_interest")
DERIVED_TABLES = ("bars_1s", "bars_ref")

# Metadata tables and their keys.
META_SCHEMAS: dict[str, T.StructType] = {
    "symbol_map": _struct(
        ("canonical", STRING), ("venue", STRING), ("native", STRING), ("asset_class", STRING), ("base", STRING),
        ("quote", STRING), ("effective_from_ns", LONG), ("effective_to_ns", LONG), ("note", STRING)),
    "venue_status": _struct(
        ("ts_ns", LONG), ("venue", STRING), ("symbol", STRING), ("stream", STRING), ("up", T.BooleanType()),
        ("coverage_pct", DOUBLE), ("notes", STRING)),
    "corrections": _struct(
        ("correction_id", STRING), ("recorded_at_ns", LONG), ("effective_from_ns", LONG),
        ("effective_to_ns", LONG), ("table_name", STRING), ("symbol", STRING), ("venue", STRING),
        ("kind", STRING), ("severity", STRING), ("rows_affected", LONG), ("note", STRING)),
    "daily_quality": _struct(
        ("date", STRING), ("symbol", STRING), ("venue", STRING), ("score", DOUBLE), ("grade", STRING),
        ("score_base_pct", DOUBLE), ("bars", LONG), ("expected_bars", LONG), ("completeness_pct", DOUBLE),
        ("max_gap_seconds", LONG), ("n_issues", LONG), ("n_critical", LONG), ("issues_json", STRING),
        ("computed_at_ns", LONG)),
    "coverage": _struct(
        ("table_name", STRING), ("symbol", STRING), ("venue", STRING), ("date", STRING), ("rows", LONG),
        ("first_ts_ns", LONG), ("last_ts_ns", LONG), ("span_seconds", LONG), ("bytes_on_disk", LONG),
        ("computed_at_ns", LONG)),
    "schema_version": _struct(
        ("version", INT), ("applied_at", T.TimestampType())),
}
META_KEYS = {
    "symbol_map": ("canonical", "venue", "effective_from_ns"),
    "venue_status": ("ts_ns", "venue", "symbol", "stream"),
    "corrections": ("correction_id",),
    "daily_quality": ("date", "symbol", "venue"),
    "coverage": ("table_name", "symbol", "venue", "date"),
    "schema_version": ("version",),
}

# Input of the frame normalisers: landed venue messages.
FRAMES = _struct(
        ("conn_id", STRING), ("seq", LONG), ("recv_ns", LONG), ("venue", STRING), ("raw", STRING))

BAR_COLUMNS = SCHEMAS["bars_1s"].fieldNames()


def schema_for(table: str) -> T.StructType:
    """Schema of a stored table; ``KeyError`` for a name nobody declared."""
    if table in SCHEMAS:
        return SCHEMAS[table]
    return META_SCHEMAS[table]


def conform(df, table: str, extra: list[str] | None = None):
    """Cast to the declared types, null-filling columns the input lacks; ``extra`` columns pass through."""
    from pyspark.sql import functions as F
    present = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema_for(table).fields], *(extra or []))
