import json
import random

import pytest

from marketlake.functions.timeutil import to_ns
from marketlake.operators import quality as Q
from pyspark.sql import functions as F
from tests.helpers import S, T, bars, rows, trades


def named(df):
    return {r["check"]: r for r in rows(df)}


def clean(n=200, **more):
    return [dict(s=i, px=100 + i % 5, high=106, low=99, **more) for i in range(n)]


def test_clean_bars_have_no_issue(spark):
    assert named(Q.run_checks(bars(spark, clean(600)))) == {}


def test_ohlc_violations(spark):
    b = clean(100)
    b[10]["high"] = b[10]["low"] - 1
    b[20]["volume"] = -5
    b[30]["px"] = -1
    found = named(Q.check_bar_ohlc(bars(spark, b)))
    assert found["bar.high_below_low"]["severity"] == "critical"
    assert found["bar.negative_volume"]["count"] == 1
    assert {"bar.high_below_body", "bar.nonpositive_price"} <= set(found)


def test_gap(spark):
    b = clean(200)
    for x in b[100:]:
        x["s"] += 300
    found = named(Q.check_bar_gaps(bars(spark, b)))["bar.gaps"]
    assert (found["severity"], found["count"], found["sample"]) == ("minor", 1, [301.0])
    assert named(Q.check_bar_gaps(bars(spark, b), major_gap_s=200, rel_major_k=1))["bar.gaps"]["severity"] == "major"
    sparse = [dict(s=i * 120) for i in range(20)]  # thin, not anomalous
    assert named(Q.check_bar_gaps(bars(spark, sparse))) == {}


def test_timestamps(spark):
    b = bars(spark, [dict(s=0), dict(s=0), dict(ts_ns=T + S + 5)])
    found = named(Q.check_bar_timestamps(b))
    assert found["bar.duplicate_timestamps"]["count"] == 1
    assert found["bar.timestamp_off_second_grid"]["count"] == 1
    back = bars(spark, [dict(s=s) for s in (0, 5, 3, 9)]).withColumn(
        "row", F.when(F.col("ts_ns") == T, 0).when(F.col("ts_ns") == T + 5 * S, 1)
        .when(F.col("ts_ns") == T + 3 * S, 2).otherwise(3).cast("long"))
    assert named(Q.check_bar_timestamps(back, arrival=["row"]))["bar.timestamps_out_of_order"]["count"] == 1
    assert named(Q.check_bar_timestamps(bars(spark, [dict(ts_ns=T + 5)]))) == {}  # single bar: not checked


def test_flatline(spark):
    assert named(Q.check_flatline(bars(spark, [dict(s=i, px=1) for i in range(119)]))) == {}
    found = named(Q.check_flatline(bars(spark, [dict(s=i, px=1) for i in range(130)] + [dict(s=131, px=2)])))
    assert found["bar.flatline"]["count"] == 130


def test_trades(spark):
    t = trades(spark, [(T + i, "binance", 100 + i % 3, 1 if i else 0, T + i + (6 * S if i < 2 else 0))
                       for i in range(50)]).withColumn("trade_id", (F.col("seq") % 10).cast("string"))
    t = t.withColumn("date", F.lit("d")).withColumn("price", F.when(F.col("seq") == 9, 400.0).otherwise(F.col("price")))
    found = named(Q.check_trades(t))
    assert found["trade.duplicate_trade_id"]["count"] == 40
    assert found["trade.extreme_price"]["count"] == 1
    assert found["trade.nonpositive_size"]["count"] == 1
    assert found["trade.high_receive_lag"]["count"] == 2 and "6000 ms" in found["trade.high_receive_lag"]["detail"]


def test_quotes(spark):
    q = spark.createDataFrame([("x", "v", "d", b, a) for b, a in [(100.0, 100.0)] * 3 + [(100.0, 99.0), (0.0, 1.0)]],
                              "symbol string, venue string, date string, bid_px double, ask_px double")
    found = named(Q.check_quotes(q))
    assert (found["quote.locked_book"]["count"], found["quote.crossed_book"]["count"]) == (3, 1)
    assert found["quote.nonpositive_price"]["severity"] == "critical" and "quote.implausible_spread" in found


def test_tape_outside_range_needs_two_series(spark):
    def around(*venues):
        b = [dict(s=i, venue="agg", px=200) for i in range(5)]
        return bars(spark, b + [dict(s=i, venue=v, px=100) for i in range(5) for v in venues])

    assert named(Q.check_tape_range(around("binance", "coinbase")))["agg.outside_venue_range"]["count"] == 5
    assert named(Q.check_tape_range(around("binance"))) == {}


def test_dispersion(spark):
    b = [dict(s=i, venue=v, px=p) for i in range(10) for v, p in (("binance", 100), ("okx", 101), ("agg", 100.5))]
    found = named(Q.check_dispersion(bars(spark, b)))["xvenue.dispersion"]
    assert (found["severity"], found["count"]) == ("minor", 10)


@pytest.mark.parametrize("score,grade", [(99, "A"), (95, "A"), (90, "B"), (75, "C"), (55, "D"), (10, "F")])
def test_grades(spark, score, grade):
    assert spark.range(1).select(Q.grade_of(F.lit(score)).alias("g")).first()["g"] == grade


def day_bars(spark, **seconds):
    base = to_ns("2026-05-12")
    return bars(spark, [dict(s=s, venue=v) for v, ss in seconds.items() for s in ss], base=base)


def test_tape_graded_on_coverage_and_thin_venue_not_penalised(spark):
    b = day_bars(spark, binance=range(100), coinbase=[0, 50, 99], kraken=[10, 20, 30], agg=range(100))
    cards = {r["venue"]: r for r in rows(Q.score_cards(b))}
    assert cards["agg"]["agg_coverage_of_union_pct"] == 100 and cards["agg"]["score"] == 100
    assert cards["agg"]["score_basis"] == "coverage_of_contributing_venues" and cards["agg"]["grade"] == "A"
    assert cards["coinbase"]["completeness_pct"] < 5 and cards["coinbase"]["grade"] == "A"


def test_tape_penalised_for_missed_seconds(spark):
    b = day_bars(spark, binance=range(100), kraken=[0, 99], agg=range(90))
    card = {r["venue"]: r for r in rows(Q.score_cards(b))}["agg"]
    assert (card["agg_coverage_of_union_pct"], card["score_base_pct"], card["score"], card["grade"]) == (90, 90, 90, "B")


def test_score_and_gate(spark):
    b = clean(100)
    b[10]["high"] = b[10]["low"] - 1
    cards = Q.score_cards(bars(spark, b))
    card = rows(cards)[0]
    assert (card["n_critical"], card["n_major"], card["score"], card["grade"]) == (1, 2, 50.0, "D")
    daily = Q.daily_quality_rows(cards, 1)
    assert json.loads(rows(daily)[0]["issues_json"])[0]["severity"] == "critical"
    assert not Q.gate(daily) and Q.offenders(daily, "major").count() == 3
    with pytest.raises(ValueError):
        Q.offenders(daily, "awful")


def test_exact_percentiles_and_adjacent_decreases_equal_brute_force(spark):
    import numpy as np

    from marketlake.functions.ordered import adjacent_decreases, exact_percentiles
    rng = random.Random(4)
    data = [("hot" if i % 3 else f"k{i % 5}", rng.randrange(-10 ** 6, 10 ** 6) * rng.choice([1, 1000]), i)
            for i in range(9000)]
    data += [("hot", 10 ** 17, 9001), ("hot", -10 ** 18, 9002), ("one", 5, 9003)] + [("ties", i // 400, 9100 + i) for i in range(1000)]
    df = spark.createDataFrame(data, "k string, v long, row long")
    got = {r["k"]: r for r in rows(exact_percentiles(df, ["k"], "v", {"p50": .5, "p99": .99, "p0": 0.0, "p100": 1.0}))}
    drops = {r["k"]: r["n_decreases"] for r in rows(adjacent_decreases(df, ["k"], "v", None, "row", block_rows=50))}
    for k in {d[0] for d in data}:
        vs = [v for kk, v, _ in data if kk == k]
        assert got[k]["p50"] == pytest.approx(np.percentile(vs, 50)) and got[k]["p0"] == min(vs)
        assert got[k]["p99"] == pytest.approx(np.percentile(vs, 99)) and got[k]["p100"] == max(vs)
        assert drops[k] == int((np.diff(vs) < 0).sum())


def test_percentiles_of_a_key_the_sketch_misses(spark, monkeypatch):
    """Bounds that are off are noticed by the counts, and the key is ranked between its extremes."""
    import numpy as np

    from marketlake.functions import ordered
    data = [("a", float(i * i % 997)) for i in range(500)] + [("b", float(i)) for i in range(300)] + [(None, 4.0), (None, 5.0)]
    df = spark.createDataFrame(data, "k string, v double")
    real = F.percentile_approx
    monkeypatch.setattr(ordered.F, "percentile_approx", lambda c, p, a: F.transform(real(c, p, a), lambda x: x + 1000.5))
    got = {r["k"]: (r["p25"], r["p90"]) for r in rows(ordered.exact_percentiles(df, ["k"], "v", {"p25": .25, "p90": .9}))}
    for k in ("a", "b", None):
        vs = [v for kk, v in data if kk == k]
        assert got[k] == (pytest.approx(np.percentile(vs, 25)), pytest.approx(np.percentile(vs, 90)))


@pytest.mark.parametrize("cell", [1, 7, 1000])
def test_as_of_equals_brute_force(spark, cell):
    from marketlake.functions.ordered import as_of
    rng = random.Random(6)
    states = [(rng.choice(["a", "b", None]), rng.randrange(-60, 200), i) for i in range(40)]
    states = list({(k, t): (k, t, i) for k, t, i in states}.values())
    data = [(rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(-80, 240), i) for i in range(500)]
    got = rows(as_of(spark.createDataFrame(data, "k string, t long, i long"), spark.createDataFrame(states, "k string, since long, s long"),
                     ["k"], "t", "since", ["s"], cell), "i")
    assert len(got) == len(data)
    for r, (k, t, i) in zip(got, data):
        held = [(since, s) for kk, since, s in states if kk == k and since <= t]
        assert (r["i"], r["s"]) == (i, max(held)[1] if held else None)
