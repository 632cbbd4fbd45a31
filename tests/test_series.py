"""Ordered operators against plain sequential folds."""

import math
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlewright.functions.text import fixed, round_exact
from candlewright.operators import indicators as I
from candlewright.operators.cooldown import apply_cooldown
from candlewright.operators.quantiles import exact_quantiles
from candlewright.operators.series import blocks, ema_columns, positions, running_totals, time_bounds, with_range

START = datetime(2020, 1, 1)


def bars(spark, series):
    rows = [(s, (START + timedelta(days=i)).date(), c, c + 1, c - 1, c, 10)
            for s, closes in series.items() for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, trade_date date, open double, high double, low double, close double, volume bigint")


def ema(values, alpha):
    out, y = [], None
    for x in values:
        if x is not None:
            y = x if y is None else (1 - alpha) * y + alpha * x
        out.append(y)
    return out


def near(a, b, tol=1e-9):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, rel_tol=tol, abs_tol=tol))


def test_daily_indicators_match_a_sequential_fold_across_blocks(spark):
    rng = random.Random(1)
    series = {"A": [100.0], "B": [50.0]}
    for s, n in (("A", 5000), ("B", 60)):
        for _ in range(n - 1):
            series[s].append(max(1.0, series[s][-1] + rng.uniform(-3, 3)))
    got = {}
    for r in I.daily_indicators(bars(spark, series)).collect():
        got.setdefault(r["symbol"], []).append(r)
    for s, closes in series.items():
        rows = sorted(got[s], key=lambda r: r["trade_date"])
        assert len(rows) == len(closes)
        deltas = [None] + [b - a for a, b in zip(closes, closes[1:])]
        gains = ema([None if x is None else max(x, 0) for x in deltas], 1 / 14)
        losses = ema([None if x is None else max(-x, 0) for x in deltas], 1 / 14)
        e12, e26 = ema(closes, 2 / 13), ema(closes, 2 / 27)
        for i, r in enumerate(rows):
            assert near(r["ema_12"], e12[i]) and near(r["ema_26"], e26[i]) and near(r["macd"], e12[i] - e26[i], 1e-8)
            rsi = None if i == 0 else 100.0 if losses[i] == 0 else 100 - 100 / (1 + gains[i] / losses[i])
            assert near(r["rsi_14"], rsi, 1e-8)
            assert near(r["sma_20"], sum(closes[i - 19:i + 1]) / 20 if i >= 19 else None)
            assert near(r["sma_50"], sum(closes[i - 49:i + 1]) / 50 if i >= 49 else None)
            assert near(r["price_change_pct"], closes[i] / closes[i - 1] - 1 if i else None)


@pytest.mark.parametrize("closes, rsi", [([5.0], [None]), ([5.0] * 4, [None, 100, 100, 100]), ([4.0, 3.0, 2.0], [None, 0, 0])])
def test_rsi_edges(spark, closes, rsi):
    rows = I.daily_indicators(bars(spark, {"A": closes})).orderBy("trade_date").collect()
    assert [r["rsi_14"] for r in rows] == rsi


def test_null_inside_a_series_repeats_the_average(spark):
    rows = I.daily_indicators(bars(spark, {"A": [10.0, 12.0, 14.0]}).withColumn(
        "close", F.when(F.dayofmonth("trade_date") != 2, F.col("close")))).orderBy("trade_date").collect()
    assert [r["ema_12"] for r in rows] == pytest.approx(ema([10.0, None, 14.0], 2 / 13))


def candles(spark, n, seed=0, symbol="A", step=60):
    rng = random.Random(seed)
    rows = [(symbol, START + timedelta(seconds=step * i), START + timedelta(seconds=step * i + 1), float(rng.randint(40, 60)), rng.randint(0, 50))
            for i in range(n)]
    df = spark.createDataFrame(rows, "symbol string, candle_time timestamp, received_at timestamp, close double, volume bigint")
    return rows, df.withColumns({c: F.col("close") for c in ("open", "high", "low")})


def test_positions_by_bucket_equal_plain_positions(spark):
    rows, df = candles(spark, 500)
    both = df.unionByName(df.withColumn("symbol", F.lit("B")).limit(77))
    a = {(r["symbol"], r["candle_time"]): r["_pos"] for r in positions(both, ["symbol"], ["candle_time"]).collect()}
    b = {(r["symbol"], r["candle_time"]): r["_pos"] for r in positions(both, ["symbol"], ["candle_time"], F.date_trunc("hour", "candle_time")).collect()}
    assert a == b and max(a.values()) == 499


def test_blocks_repeat_exactly_the_halo(spark):
    df = spark.range(100).select(F.lit("A").alias("symbol"), F.col("id").alias("_pos"))
    cut = blocks(df, halo=5, size=20)
    assert cut.where("_core").count() == 100
    assert sorted(r["_pos"] for r in cut.where("_block = 2 AND NOT _core").collect()) == [35, 36, 37, 38, 39]
    with pytest.raises(ValueError):
        blocks(df, halo=30, size=20)


@pytest.mark.parametrize("alpha", [1 / 14, 2 / 201, 0.9, 1e-5])
def test_averages_of_sparse_series(spark, alpha):
    """Long runs of nulls at both ends and inside, over many buckets."""
    rng = random.Random(3)
    values = [rng.uniform(1, 900) if 700 < i < 1700 or i > 1700 and i % 200 == 0 else None for i in range(6000)]
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(values)] + [("B", i, None) for i in range(3)], "symbol string, _pos long, x double")
    got = {(r["symbol"], r["_pos"]): r["y"] for r in ema_columns(df, ["symbol"], {"y": ("x", alpha), "z": ("x", 0.5)}).collect()}
    y = None
    for i, v in enumerate(values):
        y = v if y is None else y if v is None else (1 - alpha) * y + alpha * v
        assert got["A", i] == (None if y is None else pytest.approx(y, rel=1e-9)), i
    assert all(got["B", i] is None for i in range(3))


def test_running_totals_and_numbers(spark):
    rows, df = candles(spark, 300)
    out = running_totals(df.withColumn("day", F.to_date("candle_time")), ["symbol"], ["candle_time"], F.date_trunc("hour", "candle_time"),
                         {"total": F.col("volume")}, within=["day"], number=True).orderBy("candle_time").collect()
    run = 0
    for i, (r, row) in enumerate(zip(out, rows)):
        run += row[4]
        assert r["total"] == run and r["_pos"] == i


def test_candle_indicators_against_plain_python(spark):
    rows, df = candles(spark, 400, seed=3)
    out = I.candle_indicators(df).orderBy("candle_time").collect()
    closes, volumes = [r[3] for r in rows], [r[4] for r in rows]
    for i, r in enumerate(out):
        want = None
        if i >= 14:
            steps = [b - a for a, b in zip(closes[i - 14:i], closes[i - 13:i + 1])]
            gain, loss = sum(s for s in steps if s > 0) / 14, sum(-s for s in steps if s < 0) / 14
            want = 100.0 if loss == 0 else 0.0 if gain == 0 else round(100 - 100 / (1 + gain / loss), 2)
        assert r["rsi_14"] == want
        mean = sum(volumes[i - 20:i]) / 20 if i >= 20 else 0
        assert r["volume_ratio"] == (round(volumes[i] / mean, 2) if mean > 0 else None)


def test_session_vwap_counts_only_trading_hours(spark):
    times = ["08:59:59", "09:00:00", "12:00:00", "14:45:00", "14:45:01"]
    df = spark.createDataFrame([("A", f"2024-01-02 {t}", float(10 + i), 10) for i, t in enumerate(times)],
                               "symbol string, t string, close double, volume bigint")
    df = df.withColumns({"candle_time": F.to_timestamp("t"), "high": F.col("close"), "low": F.col("close"), "open": F.col("close")})
    got = [r["vwap"] for r in I.session_vwap(df, session_only=True).orderBy("candle_time").collect()]
    assert got == [None, 11.0, 11.5, 12.0, 12.0]


def fires(times, wait):
    out, last = [], None
    for t in sorted(set(times)):
        if last is None or t - last >= wait:
            out.append(t)
            last = t
    return out


def test_cooldown_is_inclusive_and_by_type(spark):
    rows = [("A", k, START + timedelta(seconds=s)) for k in "xy" for s in (0, 299, 300, 301, 600, 900)]
    df = spark.createDataFrame(rows, "symbol string, alert_type string, alert_time timestamp")
    got = sorted((r["alert_time"] - START).total_seconds() for r in apply_cooldown(df).where("alert_type = 'x'").collect())
    assert got == [0, 300, 600, 900]


@pytest.mark.parametrize("gap", [7, 120, 290, 4000])
def test_cooldown_matches_a_fold_on_long_chains(spark, gap):
    rng = random.Random(gap)
    t, rows = 0, []
    for _ in range(1500):
        t += rng.randint(1, gap)
        rows.append(("A", "x", START + timedelta(seconds=t)))
    df = spark.createDataFrame(rows, "symbol string, alert_type string, alert_time timestamp")
    got = sorted((r["alert_time"] - START).total_seconds() for r in apply_cooldown(df).collect())
    assert got == fires([(r[2] - START).total_seconds() for r in rows], 300)


@pytest.mark.parametrize("method", ["linear", "nearest", "lower", "higher", "midpoint"])
def test_exact_quantiles(spark, method):
    import numpy as np

    rng = random.Random(5)
    data = {g: [rng.choice([0.0, -1.5, 3.25]) if rng.random() < 0.4 else rng.gauss(0, 10.0 ** rng.randint(-3, 6)) for _ in range(n)]
            for g, n in (("a", 101), ("b", 40), (None, 1))}
    df = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs] + [("a", None)], "g string, v double")
    got = exact_quantiles(df, ["g"], "v", [0.1, 0.5, 0.95], ["p", "q", "r"], method).collect()
    assert len(got) == 3
    for r in got:
        want = np.quantile(data[r["g"]], [0.1, 0.5, 0.95], method=method)
        assert [r["p"], r["q"], r["r"]] == pytest.approx(list(want), rel=1e-12, abs=1e-12)


def test_quantiles_of_extremes_and_of_nothing(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 3.0, 1e308, 1.797e308, -inf, inf, inf)], "v double")
    row = exact_quantiles(df, [], "v", [0.0, 0.5, 1.0], ["a", "b", "c"], "lower").first()
    assert tuple(row) == (-inf, 3.0, inf)
    assert tuple(exact_quantiles(df.where("v < 1e307 OR v > 1.7e308"), [], "v", [1.0], ["m"]).first()) == (inf,)
    assert exact_quantiles(df.limit(0), [], "v", [0.5], ["m"]).collect() == [(None,)]
    with pytest.raises(ValueError):
        exact_quantiles(df, [], "v", [0.5], ["m"], True)
    stamps = spark.range(20000).select((F.col("id") * 100000 + 1.7e15).alias("v"))
    assert exact_quantiles(stamps, [], "v", [0.25], ["q"]).first()["q"] == 1.7e15 + 4999.75 * 100000


@pytest.mark.parametrize("seconds", [7200, 0])
def test_cooldowns_of_any_length(spark, seconds):
    rng = random.Random(2)
    times = sorted({rng.randint(0, 200000) for _ in range(300)})
    df = spark.createDataFrame([("A", "x", START + timedelta(seconds=t)) for t in times], "symbol string, alert_type string, alert_time timestamp")
    got = sorted((r["alert_time"] - START).total_seconds() for r in apply_cooldown(df, seconds).collect())
    assert got == fires(times, seconds)


def test_exact_rounding_follows_the_binary_value(spark):
    rng = random.Random(9)
    values = [43.125, 2.675, 2.075, 0.5, 1.5, 2.5, 99.995, 1e-9, 0.0, 31.9999999999, 12345.65] + [rng.uniform(0, 2000) for _ in range(300)]
    values += [round(v, 2) + 0.005 for v in values]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(
        "v", round_exact(F.col("v"), 2).alias("r2"), fixed(F.col("v"), 0).alias("f0"), fixed(F.col("v"), 1).alias("f1"),
        fixed(-F.col("v"), 2).alias("n2")).collect()
    for r in rows:
        v = r["v"]
        assert r["r2"] == round(v, 2) and r["f0"] == f"{v:.0f}" and r["f1"] == f"{v:.1f}"
        assert r["n2"] == (f"{-v:.2f}" if v > 0 else "0.00")


def candles_of_one_hour(spark, n):
    """All rows belong to one symbol and hour."""
    i = F.col("id")
    return spark.range(n).select(
        F.lit("HOT").alias("symbol"), (F.lit(START) + F.make_dt_interval(secs=(i * 3600 / n).cast("decimal(18,6)"))).cast("timestamp").alias("candle_time"),
        (F.lit(START) + F.make_dt_interval(secs=(i * 3600 / n).cast("decimal(18,6)"))).cast("timestamp").alias("received_at"),
        *[(50 + (i * 37 % 101) / 10).alias(c) for c in ("open", "high", "low", "close")], (1 + i * 13 % 97).alias("volume"),
    )


def test_a_hot_symbol_is_cut_where_its_rows_are(spark):
    n = 40_000
    candles = candles_of_one_hour(spark, n).repartition(7)
    bounds = time_bounds(candles, "candle_time", 16)
    sizes = [r["count"] for r in with_range(candles, "candle_time", bounds).groupBy("symbol", "_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 1.2 * n / 16
    got = I.session_vwap(candles, number=True).select("_pos", "volume", "close", "vwap").orderBy("_pos").collect()
    v = pv = 0.0
    assert [r["_pos"] for r in got] == list(range(n))
    for i, r in enumerate(got):
        assert r["volume"] == 1 + i * 13 % 97
        v, pv = v + r["volume"], pv + r["volume"] * r["close"]
        assert near(r["vwap"], pv / v)


def test_a_range_across_two_days(spark):
    """Few ranges over many days: positions go on, sums begin anew every day."""
    rows = [("A" if i % 3 else "B", START + timedelta(hours=i), 10.0, 10.0, 10.0, 10.0 + i % 7, 1 + i % 5) for i in range(300)]
    candles = spark.createDataFrame(rows, "symbol string, candle_time timestamp, open double, high double, low double, close double, volume bigint").repartition(5)
    for n in (2, 5):
        got = I.session_vwap(candles, number=True, bounds=time_bounds(candles, "candle_time", n)).collect()
        for s in "AB":
            mine = sorted((r for r in got if r["symbol"] == s), key=lambda r: r["candle_time"])
            assert [r["_pos"] for r in mine] == list(range(len(mine)))
            v = pv = 0.0
            for a, r in zip([None, *mine], mine):
                if a is None or a["candle_time"].date() != r["candle_time"].date():
                    v = pv = 0.0
                v, pv = v + r["volume"], pv + r["volume"] * (20.0 + r["close"]) / 3
                assert near(r["vwap"], pv / v)


def test_ranges_of_nothing_and_of_one_moment(spark):
    candles = candles_of_one_hour(spark, 50)
    assert time_bounds(candles.limit(0), "candle_time") == [] and I.session_vwap(candles.limit(0)).count() == 0
    same = candles.withColumn("candle_time", F.lit(START).cast("timestamp"))
    assert sorted(r["_pos"] for r in I.candle_positions(same).collect()) == list(range(50))


def test_a_key_that_never_pauses(spark):
    """60,000 candidates a second apart and a key with nulls, without any array of a key's times."""
    long = spark.range(60_000).select(F.lit("A").alias("symbol"), F.lit("x").alias("alert_type"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id")).alias("alert_time"))
    other = spark.range(900).select(F.lit(None).cast("string").alias("symbol"), F.lit("x").alias("alert_type"), F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 7).alias("alert_time"))
    fired = apply_cooldown(long.union(other))
    assert "collect_list" not in fired._jdf.queryExecution().toString()
    got = {}
    for r in fired.select("symbol", F.unix_seconds("alert_time").alias("t")).collect():
        got.setdefault(r["symbol"], []).append(r["t"] - 1_600_000_000)
    assert sorted(got["A"]) == list(range(0, 60_000, 300)) and sorted(got[None]) == fires([i * 7 for i in range(900)], 300)


def test_cooldown_of_equal_alerts_and_of_none(spark):
    rows = [("A", "x", START), ("A", "x", START), ("A", "x", None), ("A", "x", START + timedelta(seconds=10))]
    df = spark.createDataFrame(rows, "symbol string, alert_type string, alert_time timestamp")
    assert [r["alert_time"] for r in apply_cooldown(df).collect()] == [START, START]
    assert apply_cooldown(df.limit(0)).count() == 0
