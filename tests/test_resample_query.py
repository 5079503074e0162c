import pandas as pd
import pytest

from marketlake.functions.timeutil import DAY, MINUTE, parse_timeframe, to_ns
from marketlake.operators.resample import resample_bars
from marketlake.plans import query as G
from tests.helpers import S, T, bars, rows

M0 = T - T % (60 * S)


def test_minute_bars(spark):
    b = bars(spark, [dict(s=i, open=i, high=i + 1, low=i, close=i + 0.25, vwap=i, venue="agg") for i in range(120)],
             base=M0)
    got = rows(resample_bars(b, "1m"), "ts_ns")
    assert [r["ts_ns"] for r in got] == [M0, M0 + 60 * S]
    assert (got[0]["open"], got[0]["close"], got[0]["volume"], got[0]["high"]) == (0, 59.25, 60, 60)
    assert sum(r["volume"] for r in got) == 120


def test_vwap_is_volume_weighted(spark):
    b = bars(spark, [dict(s=i, vwap=100) for i in range(3)] + [dict(s=3, vwap=200)], base=M0)
    assert rows(resample_bars(b, "5s"))[0]["vwap"] == pytest.approx(125)
    empty = bars(spark, [dict(s=0, volume=0, close=7, vwap=3)], base=M0)
    assert rows(resample_bars(empty, "5s"))[0]["vwap"] == 7


def test_second_frames_pass_through_and_empty_stays_empty(spark):
    b = bars(spark, [dict(s=i) for i in range(10)])
    assert resample_bars(b, "1s").count() == 10
    assert resample_bars(b.where("false"), "1m").count() == 0


def test_timeframes():
    assert parse_timeframe("1M").step == MINUTE  # case is ignored
    assert parse_timeframe("1w").origin == 3 * DAY
    assert parse_timeframe("7h").anchored and not parse_timeframe("90min").anchored
    with pytest.raises(ValueError):
        parse_timeframe("three")


@pytest.mark.parametrize("tf,rule", [("15s", "15s"), ("7min", "7min"), ("4h", "4h"), ("1d", "1D"), ("1w", "1W"),
                                     ("5h", "5h")])
def test_grid_equals_pandas(spark, tf, rule):
    seconds = [0, 1, 59, 3600, 3601, 40_000, 90_000, 200_000, 700_000, 1_300_001]
    got = [r["ts_ns"] for r in rows(resample_bars(bars(spark, [dict(s=s) for s in seconds]), tf), "ts_ns")]
    idx = pd.to_datetime([T + s * S for s in seconds], utc=True)
    want = pd.Series(1, index=idx).resample(rule, label="left", closed="left").sum()
    assert got == [int(t.value) for t in want[want > 0].index]


def test_mask_modes(spark):
    b = bars(spark, [dict(s=0, sources_mask=5), dict(s=1, sources_mask=6)], base=M0)
    assert rows(resample_bars(b, "1m"))[0]["sources_mask"] == 6
    assert rows(resample_bars(b, "1m", mask="or"))[0]["sources_mask"] == 7


def test_asof_cuts_before_resampling(spark):
    t1, t2 = T + 100 * S, T + 200 * S
    b = bars(spark, [dict(s=i, venue="agg", ingested_at_ns=t1) for i in range(10)]
             + [dict(s=i, venue="agg", ingested_at_ns=t2) for i in range(10, 20)])

    def seen(asof):
        return G.get_bars(b, "BTC-USD", T, T + 60 * S, "1s", asof=asof).count()

    assert (seen(None), seen(t1), seen(t1 - 1), seen(t2)) == (20, 10, 0, 20)
    assert G.visible_asof(bars(spark, [dict(s=0)]), T).count() == 1  # unknown ingest time: always visible


def test_get_bars_sources_fields_and_range(spark):
    b = bars(spark, [dict(s=i, venue=v, date="2023-11-14") for i in range(10) for v in ("agg", "okx", "kraken")])
    assert G.get_bars(b, "BTC-USD", T, T + 5 * S, "1s").count() == 5  # half-open, tape by default
    both = G.get_bars(b, "BTC-USD", T, T + 5 * S, "1s", sources=["okx", "kraken"], fields=["close", "nope"])
    assert both.columns == ["close", "venue"] and both.count() == 10
    assert G.get_bars(b, "BTC-USD", "2023-11-14 22:13:20", "2023-11-14 22:13:25", "1s").count() == 5
    assert to_ns("2023-11-14 22:13:20") == T


def test_venue_filters(spark):
    b = bars(spark, [dict(venue=v) for v in ("agg", "okx", "kraken")])
    assert [G.of_venues(b, x).count() for x in (None, "all", "okx", ["okx", "agg"], [])] == [3, 3, 1, 2, 0]


def test_rebuild_doubles_unless_latest_asked(spark):
    rebuilt = [dict(s=0, venue="agg", volume=1, ingested_at_ns=1), dict(s=0, venue="agg", volume=3, ingested_at_ns=2)]
    b = bars(spark, rebuilt)
    assert rows(G.get_bars(b, "BTC-USD", T, T + S, "1m"))[0]["volume"] == 4
    assert rows(G.get_bars(b, "BTC-USD", T, T + S, "1m", versions="latest"))[0]["volume"] == 3


def test_grid_ffill(spark):
    b = bars(spark, [dict(s=0, close=1), dict(s=3, close=4)], base=M0)
    got = rows(G.grid_ffill(b, "1s", M0, M0 + 6 * S), "ts_ns")
    assert [(r["close"], r["volume"], r["filled"]) for r in got] == [
        (1, 1, False), (1, 0, True), (1, 0, True), (4, 1, False), (4, 0, True), (4, 0, True)]
