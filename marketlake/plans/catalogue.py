"""The registered queries: every operator over the market-shaped views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.timeutil import SECOND, date_of, hour_bucket, second_of
from marketlake.operators import analytics as A
from marketlake.operators import bars as B
from marketlake.operators import books as K
from marketlake.operators import coverage as C
from marketlake.operators import health as H
from marketlake.operators import quality as Q
from marketlake.operators import refdata as D
from marketlake.operators import tape as T
from marketlake.operators.bars import bars_from_trades
from marketlake.operators.resample import resample_bars
from marketlake.plans import query as G
from marketlake.plans.market_views import T0, MarketViews
from marketlake.plans.pipeline import build_dataset, write_daily_quality
from marketlake.plans.status import bars_span, status_report, write_artefacts
from marketlake.session import ensure_session, shared_dir
from marketlake.sources.store import ARRIVAL, Lake, latest_by_key
from marketlake.sources.venues import list_symbols, symbol_dim

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(*names: str):
    """Register ``fn(views, name)`` under each name."""
    def add(fn):
        for name in names:
            _QUERIES[name] = lambda spark, sf_dir, n=name: fn(MarketViews(ensure_session(spark), sf_dir), n)
        return fn
    return add


def r(df: DataFrame, columns: str, digits: int = 6) -> DataFrame:
    """Round presentation columns, nudged off exact halves, so that summation order cannot show."""
    return df.withColumns({c: rnd(c, digits) for c in columns.split()})


def rnd(c, digits: int = 6) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) + F.lit(1e-11), digits)


def joined(c) -> Column:
    return F.array_join(c, ",")


OHLC = "open high low close volume vwap"
BARS_OUT = ["ts_ns", "symbol", "venue", *OHLC.split(), "trades", "sources_mask", "ingested_at_ns"]


def bars_out(df: DataFrame, *more) -> DataFrame:
    return r(df, OHLC).select(*BARS_OUT, *more)


def ts_text(c="ts") -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts")


# ---- tape and bars ----

def tape_diag_of(v: MarketViews) -> DataFrame:
    return T.tape_with_diagnostics(T.spot_only(v.trades))


@query("tape_1s")
def _tape(v, n):
    return bars_out(v.tape)


@query("tape_diag")
def _tape_diag(v, n):
    d = T.filter_diagnostics(T.spot_only(v.trades))
    return r(d.withColumn("venues", joined("venues")), "median_px")


@query("tape_mask")
def _tape_mask(v, n):
    return (v.tape.groupBy("symbol", "sources_mask").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("n_venues", F.bit_count("sources_mask")))


@query("tape_gates")
def _tape_gates(v, n):
    gated = T.gate_trades(v.trades, excluded_venues=["kraken"])
    return gated.groupBy("symbol", "venue").agg(F.count(F.lit(1)).alias("n"))


@query("tape_filter_diag")
def _tape_filter(v, n):
    return (tape_diag_of(v).where(F.col("n_dropped") > 0).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("fired_seconds"), F.sum("n_dropped").alias("dropped")))


@query("tape_run_summary")
def _run_summary(v, n):
    feeds = T.spot_only(v.trades).groupBy("symbol", "venue").agg(F.count(F.lit(1)).alias("trades"))
    return T.run_summary(tape_diag_of(v), feeds).withColumn(
        "contributing_venues", joined("contributing_venues"))


@query("tape_health_excluded")
def _tape_health(v, n):
    return bars_out(T.build_tape(T.exclude_down(T.spot_only(v.trades), v.status)))


@query("tape_hot_second")
def _tape_hot(v, n):
    """A third of all trades in one second, nearly each at a price of its own; medians by weights along sorted levels."""
    third = F.col("seq") % 3 == 0
    trades = v.trades.withColumns({
        "ts_ns": F.when(third, F.lit(T0)).otherwise(F.col("ts_ns")), "recv_ns": F.when(third, F.lit(T0)).otherwise(F.col("recv_ns")),
        "price": F.when(third, F.col("price") + F.col("seq") / 1e7).otherwise(F.col("price"))})
    d = T.tape_with_diagnostics(T.spot_only(trades), hot_levels=64)
    return r(d.withColumn("venues", joined("venues")), f"{OHLC} median_px")


@query("merged_tape")
def _merged(v, n):
    return T.merge_trades(T.spot_only(v.trades)).select("symbol", "ts_ns", "recv_ns", "venue", "seq", "price",
                                                        "size")


@query("bars_1s_venue")
def _venue_bars(v, n):
    return bars_out(v.venue_bars)


@query("agg_second")
def _blend(v, n):
    return bars_out(B.blend_bars(v.venue_bars)).drop("ingested_at_ns")


@query("entry_tape_1m")
def _entry(v, n):
    return bars_out(resample_bars(v.tape, "1m"))


@query("resample_5s", "resample_1m", "resample_15m", "resample_4h", "resample_1d", "resample_1w", "resample_7h")
def _resample(v, n):
    return bars_out(resample_bars(v.bars.select(*BARS_OUT), n.split("_")[1]))


@query("resample_mask_or")
def _mask_or(v, n):
    return resample_bars(v.bars, "1m", mask="or").select("ts_ns", "symbol", "venue", "sources_mask")


# ---- query functions ----

def at(seconds: int) -> int:
    return T0 + seconds * SECOND


SYMBOLS = ["SYM0", "SYM1", "SYM2"]
FAR = 4_102_444_800 * SECOND  # the year 2100: later than any row, however many events there are


@query("get_bars_1s", "get_bars_1m", "get_bars_5m", "get_bars_1h", "get_bars_1d")
def _get_bars(v, n):
    return bars_out(G.get_bars(v.bars, SYMBOLS, at(10), at(4000), n.split("_")[2]), ts_text())


@query("get_bars_multi")
def _get_bars_multi(v, n):
    return bars_out(G.get_bars(v.bars, SYMBOLS, at(0), FAR, "5m", sources=["binance", "coinbase"]), ts_text())


@query("bars_asof")
def _asof(v, n):
    return bars_out(G.get_bars(v.bars, SYMBOLS, at(0), FAR, "1m", asof=at(310)), ts_text())


@query("bars_fields")
def _fields(v, n):
    return r(G.get_bars(v.bars, SYMBOLS, at(0), FAR, "5m", sources=["binance", "coinbase"],
                        fields=["close", "volume", "no_such_column"]), "close volume")


@query("bars_tz")
def _tz(v, n):
    return r(G.get_bars(v.bars, SYMBOLS, at(0), FAR, "5m", tz="Asia/Tokyo"), "close").select(
        "symbol", ts_text(), "close")


@query("bars_fill_zero")
def _fill_zero(v, n):
    old = v.bars.withColumn("ingested_at_ns", F.lit(None).cast("long"))
    return bars_out(G.get_bars(old, SYMBOLS, at(0), FAR, "5m", fill="zero"))


@query("bars_grid_ffill")
def _grid(v, n):
    return r(G.grid_ffill(v.bars, "5s"), "open high low close volume")


@query("grid_7h_end")
def _grid_7h(v, n):
    """Windows anchored at each series' own first bar, carried on to an end two days later."""
    return r(G.grid_ffill(v.bars, "7h", end=at(200_000)), "open high low close volume")


@query("bars_fill_ffill")
def _fill_ffill(v, n):
    return bars_out(G.get_bars(v.bars, SYMBOLS, at(0), FAR, "5m", fill="ffill"))


@query("bars_latest_version")
def _latest(v, n):
    bars = v.bars
    rebuilt = bars.unionByName(bars.withColumns({"volume": F.col("volume") * 2,
                                                 "ingested_at_ns": F.col("ingested_at_ns") - 1}))
    return bars_out(G.get_bars(rebuilt, SYMBOLS, at(0), FAR, "1m", versions="latest"), ts_text())


@query("get_trades")
def _get_trades(v, n):
    return G.get_trades(v.trades, "SYM1", at(100), at(2000), ["binance", "okx"]).drop("ts")


@query("get_quotes")
def _get_quotes(v, n):
    return r(G.get_quotes(v.quotes, "SYM1", at(100), at(2000)).drop("ts"), "bid_px ask_px bid_sz ask_sz")


@query("get_funding")
def _get_funding(v, n):
    return r(r(G.get_funding(v.funding, "SYM1-PERP", at(100), at(2000)).drop("ts"), "funding_rate", 10), "mark_price")


@query("funding_wide")
def _funding_wide(v, n):
    return r(G.funding_wide(v.funding, ["bybit", "okx"]), "bybit okx", 10)


@query("get_open_interest")
def _get_oi(v, n):
    return G.get_open_interest(v.open_interest, "SYM2-PERP", at(100), at(2000)).drop("ts")


@query("ref_bars")
def _ref(v, n):
    ref = resample_bars(v.venue_bars, "1m").withColumn("interval", F.lit("1m"))
    return r(G.get_ref_bars(ref, "SYM0", at(0), at(2000), "1m").drop("ts"), "open high low close volume")


@query("book_snapshots")
def _snapshots(v, n):
    last = F.size("bids") - 1
    s = G.get_book_snapshots(v.books, "SYM0", at(100), at(2000), "okx", levels=2)
    return s.select("ts_ns", "recv_ns", "venue", "depth", F.size("bids").cast("long").alias("n_bids"),
                    rnd(F.get("bids", last)["px"]).alias("last_bid_px"),
                    rnd(F.get("asks", last)["px"]).alias("last_ask_px"),
                    rnd(F.get("bids", last)["sz"]).alias("last_bid_sz"))


@query("book_symbols")
def _book_symbols(v, n):
    return G.list_book_symbols(v.books)


@query("venue_status")
def _status(v, n):
    return G.venue_status(v.status, at(100))


@query("scan_trades")
def _scan(v, n):
    return v.trades.groupBy("symbol", "venue", "date").agg(
        F.count(F.lit(1)).alias("n"), F.min("ts_ns").alias("first_ts_ns"), F.max("ts_ns").alias("last_ts_ns"))


@query("slices_present")
def _slices(v, n):
    return v.trades.select("symbol", "date").distinct()


@query("part_date")
def _part_date(v, n):
    return v.trades.groupBy(date_of("ts_ns").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@query("hour_bucket")
def _hour(v, n):
    return v.trades.groupBy("symbol", "venue", hour_bucket("ts_ns").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"))


@query("sql_adhoc")
def _adhoc(v, n):
    return v.spark.sql("SELECT venue, count(*) AS n, min(ts_ns) AS lo, max(ts_ns) AS hi FROM {bars_1s} "
                       "WHERE symbol = :symbol GROUP BY venue", args={"symbol": "SYM0"}, bars_1s=v.bars)


@query("top_series")
def _top(v, n):
    return (v.bars.groupBy("symbol", "venue")
            .agg(F.count(F.lit(1)).alias("n"), F.min("ts_ns").alias("lo"), F.max("ts_ns").alias("hi"))
            .orderBy(F.desc("n"), "symbol", "venue").limit(1))


# ---- books ----

@query("book_top")
def _book_top(v, n):
    return r(K.book_top(v.books), "bid_px bid_sz ask_px ask_sz mid spread_bps imbalance")


@query("book_quality")
def _book_quality(v, n):
    damaged = v.books.select(
        "symbol", "venue",
        F.when(F.col("seq") % 11 == 0, F.reverse("bids"))
        .when(F.col("seq") % 13 == 0, F.array(F.get("bids", F.lit(0)), F.get("bids", F.lit(0)), F.get("bids", F.lit(2))))
        .otherwise(F.col("bids")).alias("bids"),
        F.when(F.col("seq") % 7 == 0, F.slice("asks", 1, 0)).otherwise(F.col("asks")).alias("asks"))
    return K.book_quality(damaged)


# ---- quality ----

def lean(issues: DataFrame) -> DataFrame:
    return issues.drop("detail", "sample")


def sec_mod(m: int) -> Column:
    return F.call_function("div", F.col("ts_ns"), F.lit(SECOND)) % m


@query("dq_bar_ohlc")
def _dq_ohlc(v, n):
    bad = v.bars.withColumns({
        "high": F.when(sec_mod(50) == 7, F.col("low") - 1).otherwise(F.col("high")),
        "volume": F.when(sec_mod(70) == 3, -F.col("volume") - 1).otherwise(F.col("volume"))})
    return lean(Q.check_bar_ohlc(bad))


@query("dq_bar_ts")
def _dq_ts(v, n):
    bad = v.bars.withColumn("ts_ns", F.when(sec_mod(40) == 5, F.col("ts_ns") + 1000000)
                            .when(sec_mod(40) == 6, F.col("ts_ns") - SECOND).otherwise(F.col("ts_ns")))
    return lean(Q.check_bar_timestamps(bad))


def gappy(v: MarketViews) -> DataFrame:
    return v.bars.where(sec_mod(400) < 300)


@query("bar_diffs")
def _bar_diffs(v, n):
    return r(Q.bar_diffs(gappy(v)), "gap_s")


@query("dq_bar_gaps")
def _dq_gaps(v, n):
    found = Q.check_bar_gaps(gappy(v))
    return found.select(*Q.SLICE, "check", "severity", "count",
                        joined(F.transform("sample", lambda x: x.cast("long").cast("string"))).alias("top"))


def coarse(v: MarketViews) -> DataFrame:
    return v.bars.withColumn("close", F.round("close", 0))


@query("flatline")
def _flat(v, n):
    return Q.bar_stats(coarse(v)).select(*Q.SLICE, "bars", F.col("longest_run").alias("longest"))


@query("dq_flatline")
def _dq_flat(v, n):
    return lean(Q.check_flatline(coarse(v), min_run=5))


@query("dq_trades")
def _dq_trades(v, n):
    seq = F.col("seq")
    rough = v.trades.withColumns({
        "price": F.when(seq % 500 == 1, F.col("price") * 3).when(seq % 700 == 2, -F.col("price"))
        .otherwise(F.col("price")),
        "side": F.when(seq % 90 == 4, 5).otherwise(F.col("side")).cast("byte")})
    return lean(Q.check_trades(rough))


@query("lag_p99")
def _lag(v, n):
    varied = v.trades.withColumn("recv_ns", F.col("recv_ns") + F.col("seq") % 1000000)
    return r(Q.lag_p99_ms(varied), "p99_ms", 4)


@query("ts_out_of_order")
def _out_of_order(v, n):
    from marketlake.functions.ordered import adjacent_decreases
    shaken = v.trades.withColumn("ts_ns", F.when(F.col("seq") % 9 == 0, F.col("ts_ns") - 3 * SECOND)
                                 .otherwise(F.col("ts_ns")))
    return adjacent_decreases(shaken, Q.SLICE, "ts_ns", None, "seq", block_rows=4096)


@query("dq_quotes")
def _dq_quotes(v, n):
    seq = F.col("seq")
    bad = v.quotes.withColumns({
        "bid_px": F.when(seq % 300 == 9, 0.0).otherwise(F.col("bid_px")),
        "ask_px": F.when(seq % 170 == 9, F.col("ask_px") + 20).otherwise(F.col("ask_px"))})
    return lean(Q.check_quotes(bad))


@query("dq_agg_range")
def _dq_range(v, n):
    return lean(Q.check_tape_range(v.bars))


@query("dq_dispersion")
def _dq_disp(v, n):
    return lean(Q.check_dispersion(v.bars))


@query("completeness")
def _completeness(v, n):
    return Q.completeness(v.bars)


@query("agg_union_coverage")
def _coverage(v, n):
    return Q.tape_coverage(v.bars)


def all_issues(v: MarketViews) -> DataFrame:
    return Q.run_checks(v.stored_bars, v.trades, v.quotes)


def cards(v: MarketViews) -> DataFrame:
    return Q.score_cards(v.stored_bars, v.trades, v.quotes)


def issue_text(c="issues") -> Column:
    return F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["check"], x["severity"],
                                                             x["count"].cast("string"))), ";").alias("issues")


@query("run_checks")
def _run_checks(v, n):
    return lean(Q.sorted_issues(all_issues(v)))


@query("quality_score")
def _score(v, n):
    return Q.slice_scores(v.stored_bars, v.trades, v.quotes).withColumn("issues", issue_text())


@query("score_day")
def _score_day(v, n):
    return cards(v).withColumn("issues", issue_text())


@query("daily_quality")
def _daily(v, n):
    return Q.daily_quality_rows(cards(v)).drop("issues_json", "computed_at_ns")


@query("quality_summary")
def _summary(v, n):
    return Q.quality_summary(cards(v)).withColumns({c: joined(c) for c in ("symbols", "venues", "dates")})


@query("quality_offenders")
def _offenders(v, n):
    return Q.offenders(Q.daily_quality_rows(cards(v)), "major")


@query("quality_latest")
def _quality_latest(v, n):
    return Q.latest_cards(Q.daily_quality_rows(cards(v)))


# ---- store ----

@query("scan_empty")
def _scan_empty(v, n):
    lake = Lake(v.spark, shared_dir(v.spark, "empty"))
    empty = lake.table("quotes").agg(F.count(F.lit(1)).alias("n"))
    events = v.trades.groupBy(F.lit("quotes").alias("table_name")).agg(F.count(F.lit(1)).alias("n_events"))
    return events.join(empty.withColumn("table_name", F.lit("quotes")), "table_name")


@query("sink_roundtrip")
def _sink(v, n):
    lake = Lake(v.spark, shared_dir(v.spark, "sink"))
    lake.append("trades", v.trades)
    return lake.table("trades")


@query("bars_from_store")
def _bars_from_store(v, n):
    """Ties on the event time after a store round trip: the row that was appended first opens."""
    lake = Lake(v.spark, shared_dir(v.spark, "order"))
    tied = v.trades.withColumns({"ts_ns": second_of("ts_ns"), "recv_ns": F.col("recv_ns") - F.col("seq") * 1000})
    lake.append("trades", tied, order="seq")
    return bars_out(bars_from_trades(lake.arrivals("trades"), ARRIVAL))


@query("bars_from_landed")
def _bars_from_landed(v, n):
    """Ties on the event time in landed files of very uneven size, stored as they are read: file and row decide."""
    tied = v.trades.withColumns({"ts_ns": second_of("ts_ns"), "recv_ns": F.col("recv_ns") - F.col("seq") * 1000,
                                 "part": F.format_string("%02d", F.floor(F.log2(F.col("seq") + 1)).cast("int"))})
    landed = shared_dir(v.spark, "landed")
    tied.repartition("part").sortWithinPartitions("part", "seq").write.partitionBy("part").parquet(landed)
    lake = Lake(v.spark, shared_dir(v.spark, "landed-lake"))
    lake.append("trades", v.spark.read.schema(tied.schema).parquet(landed))
    return bars_out(bars_from_trades(lake.arrivals("trades"), ARRIVAL))


@query("dq_order")
def _dq_order(v, n):
    """Backward steps in order of arrival, of stored trades and bars."""
    lake = Lake(v.spark, shared_dir(v.spark, "damaged"))
    shaken = F.when(F.col("seq") % 9 == 0, F.col("ts_ns") - 3 * SECOND).otherwise(F.col("ts_ns"))
    lake.append("trades", v.trades.withColumn("ts_ns", shaken), order="seq")
    lake.append("bars_1s", v.bars.withColumn("place", F.col("ts_ns") + F.when(
        sec_mod(7) == 3, 5 * SECOND + 1).otherwise(0)), order="place")
    steps = [Q.check_bar_timestamps(lake.arrivals("bars_1s"), arrival=ARRIVAL),
             Q.check_trades(lake.arrivals("trades"), arrival=ARRIVAL)]
    found = Q.union_issues(*steps).where(F.endswith("check", F.lit("out_of_order")))
    return found.select(*Q.SLICE, "check", "severity", "count")


@query("quality_json")
def _quality_json(v, n):
    """Cards as JSON per date: scoring one date again leaves the others."""
    lake, base = Lake(v.spark, shared_dir(v.spark, "json-lake")), shared_dir(v.spark, "json")
    lake.append("bars_1s", v.bars)
    write_daily_quality(lake, json_dir=base)
    first = v.bars.agg(F.min("date")).first()[0]
    write_daily_quality(lake, dates=[str(first)], json_dir=base)
    return v.spark.read.schema("symbol string, venue string, bars long, date string").json(base)


@query("compact_rows")
def _compact(v, n):
    lake = Lake(v.spark, shared_dir(v.spark, "compact"))
    for part in range(2):
        lake.append("trades", v.trades.where(F.col("seq") % 2 == part))
    lake.compact("trades")
    files = lake.files("trades").select(*Q.SLICE, "n_files").distinct()
    rows = lake.table("trades").groupBy(*Q.SLICE).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("ts_ns") % 1000000007).alias("sum_ts"),
        F.count("trade_id").alias("n_ids"))
    return rows.join(files, list(Q.SLICE))


@query("ref_landing")
def _landing(v, n):
    lake = Lake(v.spark, shared_dir(v.spark, "ref"))
    lake.land_klines(resample_bars(v.venue_bars, "1m"), "1m")
    out = lake.table("bars_ref")
    return r(out, "open high low close volume").drop("vwap")


# ---- reference data, corrections, health, coverage, status ----

@query("list_symbols")
def _list_symbols(v, n):
    return list_symbols(v.spark).join(v.listed.groupBy("canonical").agg(F.count(F.lit(1)).alias("n_trades")), "canonical")


@query("symbols_for_venue")
def _symbols_for_venue(v, n):
    feeds = v.listed.groupBy("canonical", "venue").agg(F.count(F.lit(1)).alias("n_trades"))
    return feeds.join(F.broadcast(symbol_dim(v.spark)), ["canonical", "venue"]).drop("rank")


@query("perp_spot_split")
def _perp_spot(v, n):
    return v.listed.groupBy(D.asset_class(F.col("canonical")).alias("asset_class")).agg(
        F.count_distinct("canonical").alias("symbols"), F.count(F.lit(1)).alias("n_trades"))


@query("venues_listing")
def _venues_listing(v, n):
    dim = symbol_dim(v.spark).groupBy("canonical").agg(F.array_sort(F.collect_set("venue")).alias("venues"))
    seen = v.listed.select("canonical").distinct()
    return seen.join(F.broadcast(dim), "canonical").withColumn("venues", joined("venues"))


@query("symbol_attrs")
def _attrs(v, n):
    return D.symbol_attributes(v.listed.select("canonical").distinct())


@query("symbol_map_asof")
def _map_asof(v, n):
    return D.symbol_map_asof(v.symbol_map, at(200))


@query("symbol_map_asof_many")
def _map_asof_many(v, n):
    instants = v.trades.select((F.col("ts_ns") - F.col("ts_ns") % (10 * SECOND)).alias("ts_ns")).distinct()
    return D.symbol_map_asof_many(v.symbol_map, instants, bin_ns=60 * SECOND)


@query("symbol_map_seed")
def _map_seed(v, n):
    known = v.symbol_map.where(F.col("effective_from_ns") < at(300))
    once = D.seed_symbol_map(known, v.symbol_map)
    return D.seed_symbol_map(once, v.symbol_map)


@query("symbol_map_retire")
def _map_retire(v, n):
    closed, _ = D.retire_mapping(v.symbol_map, "BTC-USDT", "binance", at(900), "delisted")
    return closed


@query("corrections_append")
def _corrections_append(v, n):
    _, entry = D.retire_mapping(v.symbol_map, "BTC-USDT", "binance", at(900), "delisted")
    return D.valid_corrections(v.corrections.unionByName(entry)).drop("correction_id", "recorded_at_ns")


@query("corrections_list")
def _corrections_list(v, n):
    return D.list_corrections(v.corrections, table_name="trades", venue="okx", since=at(120))


@query("corrections_rollup")
def _rollup(v, n):
    return D.corrections_rollup(v.corrections)


@query("quality_upsert")
def _upsert(v, n):
    scored = Q.completeness(v.stored_bars).select(*Q.SLICE, "bars", F.lit(1).alias("version"))
    again = scored.where(F.col("venue") == "agg").withColumns({"bars": F.col("bars") + 1, "version": F.lit(2)})
    return latest_by_key(scored.unionByName(again), Q.SLICE, "version")


def feeds(v: MarketViews) -> DataFrame:
    return v.trades.select("venue", "symbol", F.lit("trades").alias("stream"), "recv_ns")


@query("feed_health")
def _feed_health(v, n):
    return r(H.feed_health(feeds(v), at(420)), "recent_per_s baseline_per_s", 8)


@query("feed_health_series")
def _feed_series(v, n):
    return r(H.health_series(H.per_step_counts(feeds(v))), "recent_per_s baseline_per_s", 8)


@query("health_latest")
def _health_latest(v, n):
    return H.latest_status(v.status)


@query("gap_worklist")
def _gaps(v, n):
    listed = v.trades.select("venue", "symbol").unionByName(
        v.listed.select("venue", F.col("canonical").alias("symbol")))
    return H.gap_worklist(v.trades.where((F.col("venue") != "okx") | (F.col("ts_ns") < at(100))), listed, at(450))


def stored_tables(v: MarketViews) -> dict[str, DataFrame]:
    day = date_of("ts_ns")
    return {"trades": v.trades, "quotes": v.quotes, "funding": v.funding.withColumn("date", day),
            "open_interest": v.open_interest.withColumn("date", day),
            "book_l2_snapshot": v.books.withColumn("date", day), "bars_1s": v.bars}


@query("coverage")
def _cov(v, n):
    return C.coverage(stored_tables(v)).drop("bytes_on_disk")


@query("coverage_by_table")
def _cov_by_table(v, n):
    return C.by_table(C.coverage(stored_tables(v))).drop("bytes")


@query("coverage_matrix")
def _cov_matrix(v, n):
    return C.matrix(C.coverage(stored_tables(v)))


@query("coverage_summary")
def _cov_summary(v, n):
    s = C.summary(C.coverage(stored_tables(v))).drop("total_bytes")
    return s.withColumns({c: joined(c) for c in ("symbols", "venues", "dates")})


@query("bars_span")
def _span(v, n):
    return bars_span(v.bars)


@query("pipeline_manifest")
def _manifest(v, n):
    lake = Lake(v.spark, shared_dir(v.spark, "lake"))
    lake.append("trades", v.trades)
    lake.append("quotes", v.quotes)
    build_dataset(lake)
    return C.by_table(lake.meta("coverage")).drop("bytes", "partitions")


@query("manifest_text")
def _manifest_text(v, n):
    """The manifest's own JSON, parsed again."""
    lake = Lake(v.spark, shared_dir(v.spark, "manifest"))
    lake.append("trades", v.trades)
    text = build_dataset(lake, {"run": 1})
    parsed = v.spark.createDataFrame([(text,)], "text string").select(F.from_json("text", """
        params struct<run:long>, bars_built struct<per_venue_1s:long,agg_1s:long,slices:long>,
        coverage struct<partitions:long,total_rows:long,total_bytes:long>, quality struct<slices:long>""").alias("m"))
    return parsed.select("m.params.run", "m.bars_built.*", "m.coverage.partitions", "m.coverage.total_rows",
                         (F.col("m.coverage.total_bytes") > 0).alias("has_bytes"), F.col("m.quality.slices").alias("cards"))


@query("coverage_footers")
def _cov_footers(v, n):
    """Coverage of a stored lake, from footers and file sizes, several files to a partition."""
    lake = Lake(v.spark, shared_dir(v.spark, "footers"))
    lake.append("trades", v.trades.where("seq % 2 = 0"))
    lake.append("trades", v.trades.where("seq % 2 = 1"))
    lake.append("quotes", v.quotes)
    return C.stored_coverage(lake).withColumn("bytes_on_disk", F.col("bytes_on_disk") > 0)


@query("status_fallback")
def _status_fallback(v, n):
    """A lake whose coverage is gone reports it from the JSON of an earlier build."""
    lake, base = Lake(v.spark, shared_dir(v.spark, "status")), shared_dir(v.spark, "artefacts")
    lake.put_meta("coverage", C.coverage(stored_tables(v)))
    write_artefacts(lake, base)
    return status_report(Lake(v.spark, shared_dir(v.spark, "bare")), base)["coverage"].drop("bytes")


@query("status_venue_status", "status_coverage", "status_quality", "status_corrections")
def _status_report(v, n):
    lake = Lake(v.spark, shared_dir(v.spark, "status"))
    if n == "status_venue_status":
        lake.put_meta("venue_status", v.status)
    elif n == "status_corrections":
        lake.put_meta("corrections", v.corrections)
    elif n == "status_coverage":
        lake.put_meta("coverage", C.coverage(stored_tables(v)), replace=True)
    else:
        lake.put_meta("daily_quality", Q.daily_quality_rows(cards(v)))
    return status_report(lake)[n.removeprefix("status_")].drop("bytes")


# ---- analytics ----

@query("wide_closes")
def _wide(v, n):
    wide = A.wide_closes(v.bars)
    return r(wide, " ".join(c for c in wide.columns if c not in ("ts_ns", "symbol")))


@query("tracking_error")
def _te(v, n):
    return r(A.tracking_error(v.bars).select("ts_ns", "symbol", "venue", "te_bps"), "te_bps")


@query("tracking_error_stats")
def _te_stats(v, n):
    return r(A.describe(A.tracking_error(v.bars), ["symbol", "venue"], "te_bps"), "mean std min max q25 q50 q75")


@query("dispersion")
def _disp(v, n):
    return r(A.dispersion(v.bars), "disp_bps")


@query("mask_presence")
def _presence(v, n):
    return r(A.mask_presence(v.tape), "share_pct", 4)


@query("mask_histogram")
def _histogram(v, n):
    return A.mask_histogram(v.tape)


@query("filter_anatomy")
def _anatomy(v, n):
    return r(A.filter_anatomy(tape_diag_of(v)), "dropped_pct")


@query("tape_breaches")
def _breaches(v, n):
    return A.tape_breaches(v.tape, T.spot_only(v.venue_bars))


def queries() -> dict[str, Query]:
    return dict(_QUERIES)
