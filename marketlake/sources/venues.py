"""Venues and listed symbols: one listing of (canonical, venue, native ticker), given or the built-in one."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Venue order.
VENUES = ("binance", "binance_futures", "bybit", "coinbase", "kraken", "okx", "bitstamp", "gemini",
          "bitfinex")
SPOT_VENUES = ("binance", "coinbase", "kraken", "okx", "bitstamp", "gemini", "bitfinex")
PERP_VENUES = ("binance_futures", "bybit")

# Canonical symbol, venue, the venue's own ticker.
LISTED = (
    ("BTC-USDT", "binance", "BTCUSDT"),
    ("BTC-USDT", "bybit", "BTCUSDT"),
    ("BTC-USDT", "kraken", "XBTUSDT"),
    ("BTC-USDT", "okx", "BTC-USDT"),
    ("BTC-USDT", "bitstamp", "btcusdt"),
    ("BTC-USDT", "gemini", "btcusdt"),
    ("BTC-USDT", "bitfinex", "tBTCUST"),
    ("BTC-USD", "coinbase", "BTC-USD"),
    ("BTC-USD", "kraken", "XBTUSD"),
    ("BTC-USD", "bitstamp", "btcusd"),
    ("BTC-USD", "gemini", "btcusd"),
    ("BTC-USD", "bitfinex", "tBTCUSD"),
    ("ETH-USDT", "binance", "ETHUSDT"),
    ("ETH-USDT", "bybit", "ETHUSDT"),
    ("ETH-USDT", "kraken", "ETHUSDT"),
    ("ETH-USDT", "okx", "ETH-USDT"),
    ("ETH-USDT", "bitstamp", "ethusdt"),
    ("ETH-USDT", "gemini", "ethusdt"),
    ("ETH-USDT", "bitfinex", "tETHUST"),
    ("ETH-USD", "coinbase", "ETH-USD"),
    ("ETH-USD", "kraken", "ETHUSD"),
    ("ETH-USD", "bitstamp", "ethusd"),
    ("ETH-USD", "gemini", "ethusd"),
    ("ETH-USD", "bitfinex", "tETHUSD"),
    ("SOL-USDT", "binance", "SOLUSDT"),
    ("SOL-USDT", "bybit", "SOLUSDT"),
    ("SOL-USDT", "okx", "SOL-USDT"),
    ("SOL-USDT", "bitstamp", "solusdt"),
    ("SOL-USDT", "bitfinex", "tSOLUST"),
    ("SOL-USD", "coinbase", "SOL-USD"),
    ("SOL-USD", "bitstamp", "solusd"),
    ("SOL-USD", "bitfinex", "tSOLUSD"),
    ("BNB-USDT", "binance", "BNBUSDT"),
    ("BNB-USDT", "bybit", "BNBUSDT"),
    ("XRP-USDT", "binance", "XRPUSDT"),
    ("XRP-USDT", "bybit", "XRPUSDT"),
    ("XRP-USD", "coinbase", "XRP-USD"),
    ("ADA-USDT", "binance", "ADAUSDT"),
    ("ADA-USDT", "bybit", "ADAUSDT"),
    ("DOGE-USDT", "binance", "DOGEUSDT"),
    ("DOGE-USDT", "bybit", "DOGEUSDT"),
    ("AVAX-USDT", "binance", "AVAXUSDT"),
    ("AVAX-USDT", "bybit", "AVAXUSDT"),
    ("LINK-USDT", "binance", "LINKUSDT"),
    ("LINK-USDT", "bybit", "LINKUSDT"),
    ("MATIC-USDT", "binance", "MATICUSDT"),
    ("MATIC-USDT", "bybit", "MATICUSDT"),
    ("DOT-USDT", "binance", "DOTUSDT"),
    ("DOT-USDT", "bybit", "DOTUSDT"),
    ("LTC-USDT", "binance", "LTCUSDT"),
    ("LTC-USDT", "bybit", "LTCUSDT"),
    ("TRX-USDT", "binance", "TRXUSDT"),
    ("TRX-USDT", "bybit", "TRXUSDT"),
    ("NEAR-USDT", "binance", "NEARUSDT"),
    ("NEAR-USDT", "bybit", "NEARUSDT"),
    ("ATOM-USDT", "binance", "ATOMUSDT"),
    ("ATOM-USDT", "bybit", "ATOMUSDT"),
    ("ARB-USDT", "binance", "ARBUSDT"),
    ("ARB-USDT", "bybit", "ARBUSDT"),
    ("OP-USDT", "binance", "OPUSDT"),
    ("OP-USDT", "bybit", "OPUSDT"),
    ("APT-USDT", "binance", "APTUSDT"),
    ("APT-USDT", "bybit", "APTUSDT"),
    ("FIL-USDT", "binance", "FILUSDT"),
    ("FIL-USDT", "bybit", "FILUSDT"),
    ("ETC-USDT", "binance", "ETCUSDT"),
    ("ETC-USDT", "bybit", "ETCUSDT"),
    ("BTC-USDT-PERP", "binance_futures", "BTCUSDT"),
    ("BTC-USDT-PERP", "bybit", "BTCUSDT"),
    ("ETH-USDT-PERP", "binance_futures", "ETHUSDT"),
    ("ETH-USDT-PERP", "bybit", "ETHUSDT"),
    ("SOL-USDT-PERP", "binance_futures", "SOLUSDT"),
    ("SOL-USDT-PERP", "bybit", "SOLUSDT"),
    ("BNB-USDT-PERP", "binance_futures", "BNBUSDT"),
    ("BNB-USDT-PERP", "bybit", "BNBUSDT"),
    ("XRP-USDT-PERP", "binance_futures", "XRPUSDT"),
    ("XRP-USDT-PERP", "bybit", "XRPUSDT"),
)

#: Rows that a listing may have: it travels inside every parser's plan.
MAX_LISTED = 20_000

DIM = "canonical string, venue string, native string, rank int"


@dataclass(frozen=True)
class Listing:
    """What each venue calls each symbol, in listing order; any ticker, whatever the venue's habit."""

    rows: tuple[tuple[str, str, str], ...] = LISTED

    @staticmethod
    def of(frame: DataFrame) -> Listing:
        """From a table with ``canonical, venue, native`` and optionally ``rank``."""
        order = ["rank"] if "rank" in frame.columns else ["canonical", "venue", "native"]
        found = frame.orderBy(*order).select("canonical", "venue", "native").limit(MAX_LISTED + 1).collect()
        if len(found) > MAX_LISTED:
            raise ValueError(f"a listing has at most {MAX_LISTED} rows")
        return Listing(tuple(tuple(r) for r in found))

    def frame(self, spark: SparkSession) -> DataFrame:
        """One row per listing with its rank, asset class and the ticker as messages may spell it."""
        dim = spark.createDataFrame([(*row, i) for i, row in enumerate(self.rows)], DIM)
        return dim.withColumns({"asset_class": F.when(is_perp(F.col("canonical")), "perp").otherwise("spot"),
                                "spelled": F.upper("native")})

    def tickers(self, venue: str) -> dict[str, str]:
        """Upper-cased ticker → canonical at one venue; of a ticker listed twice the later listing holds."""
        return dict((native.upper(), canonical) for canonical, at, native in self.rows if at == venue)


_current = Listing()


def listing() -> Listing:
    return _current


def use_listing(rows: Listing | Iterable[tuple[str, str, str]] | DataFrame | None = None) -> Listing:
    """Make a listing the one that parsers and dimensions read; none brings the built-in one back."""
    global _current
    if isinstance(rows, DataFrame):
        _current = Listing.of(rows)
    elif isinstance(rows, Listing):
        _current = rows
    else:
        _current = Listing() if rows is None else Listing(tuple(rows))
    return _current


def list_symbols(spark: SparkSession, venue: str | None = None) -> DataFrame:
    """Canonical symbols of the listing, or of one venue, in order of the name."""
    dim = symbol_dim(spark)
    return (dim if venue is None else dim.where(F.col("venue") == venue)).select("canonical").distinct().orderBy("canonical")


def is_perp(canonical: Column) -> Column:
    return F.endswith(canonical, F.lit("-PERP"))


def mask_bits(venues: Iterable[str] = VENUES) -> dict[str, int]:
    """The mask bit of each venue: two to the power of how many listed venues come before it by name."""
    listed = frozenset(venues)
    return {venue: 2 ** sum(other < venue for other in listed) for venue in listed}


def known_venue(venues: Iterable[str] | None) -> Column:
    """The venue of a row; one outside ``venues`` stops the query rather than vanish from a pivot."""
    venue = F.col("venue")
    if venues is None:
        return venue
    message = F.concat(F.lit("venue is not among the columns asked for: "), F.coalesce(venue, F.lit("null")))
    return F.when(venue.isin(list(venues)), venue).otherwise(F.raise_error(message).cast("string"))


def present_venues(df: DataFrame) -> list[str]:
    """The venues of a table, in order of the name: a handful of strings."""
    return [r["venue"] for r in df.select("venue").distinct().orderBy("venue").collect()]


def lookup(mapping: dict, key: Column) -> Column:
    """A fixed mapping as a literal map: no join, null for unknown keys."""
    literal = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return F.try_element_at(literal, key)


def venue_bit(venue: Column, bits: dict[str, int] | None = None) -> Column:
    return F.coalesce(lookup(bits or mask_bits(), venue), F.lit(0))


def canonical_of(native: Column, venue: str) -> Column:
    known = listing().tickers(venue)
    return lookup(known, F.upper(native)) if known else F.lit(None).cast("string")


def symbol_dim(spark: SparkSession) -> DataFrame:
    """(canonical, venue, native, rank): one row per listing."""
    return listing().frame(spark).select("canonical", "venue", "native", "rank")
