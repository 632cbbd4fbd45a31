"""Alert rules, messages and the stream."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from candlewright.functions import alert_rules as R
from candlewright.operators.cooldown import apply_cooldown
from candlewright.operators.replay import enrich_candles, replay_alerts
from candlewright.sources import stream as ST
from candlewright.streaming import detector

COLUMNS = "symbol string, close double, vwap double, sigma double, rsi_14 double, volume_ratio double"


def alerts(spark, rule, cfg=R.AlertConfig(), **row):
    values = {"symbol": "HPG", "close": 10.0, "vwap": 10.0, "sigma": 1.0, "rsi_14": 50.0, "volume_ratio": 1.0, **row}
    df = spark.createDataFrame([tuple(values.values())], COLUMNS).withColumn("candle_time", F.lit(datetime(2024, 1, 2, 10)))
    return R.evaluate_rules(df, [rule], cfg).collect()


@pytest.mark.parametrize("row, kind, severity, message", [
    (dict(close=12.1, rsi_14=70.0, volume_ratio=3.0), "PUMP_RISK", "CRITICAL", "HPG ⚠️ RỦI RO ĐẨY GIÁ — Breakout VWAP + RSI=70 (quá mua) + KL 3.0x"),
    (dict(close=7.9, rsi_14=30.0, volume_ratio=3.25), "PANIC_SELL", "CRITICAL", "HPG 🔴 BÁN THÁO — Breakdown VWAP + RSI=30 (quá bán) + KL 3.2x"),
    (dict(close=12.1, rsi_14=72.5), "OVERBOUGHT_BREAKOUT", "WARNING", "HPG Breakout VWAP + RSI=72 (quá mua) — cẩn trọng"),
    (dict(close=7.9, rsi_14=12.0, volume_ratio=None), "OVERSOLD_BREAKDOWN", "WARNING", "HPG Breakdown VWAP + RSI=12 (quá bán) — có thể là cơ hội"),
    (dict(rsi_14=None, volume_ratio=4.0), "UNUSUAL_VOLUME", "WARNING", "HPG 🟠 KL đột biến 4.0x — RSI=?, giá trong band VWAP"),
    (dict(close=12.1, volume_ratio=3.5), "VOLUME_BREAKOUT", "WARNING", "HPG Breakout ↑ VWAP + KL 3.5x — RSI=50"),
    (dict(close=7.9, volume_ratio=3.5, rsi_14=0.0, vwap=None), "UNUSUAL_VOLUME", "WARNING", "HPG 🟠 KL đột biến 3.5x — RSI=?, giá trong band VWAP"),
    (dict(close=7.9, volume_ratio=3.5), "VOLUME_BREAKDOWN", "WARNING", "HPG Breakdown ↓ VWAP + KL 3.5x — RSI=50"),
])
def test_combined_rule(spark, row, kind, severity, message):
    (got,) = alerts(spark, R.combined_rule, **row)
    assert (got["alert_type"], got["severity"], got["message"]) == ("COMBINED_" + kind, severity, message)


@pytest.mark.parametrize("row", [dict(close=12.0, rsi_14=90.0), dict(close=12.1, rsi_14=69.99), dict(volume_ratio=2.99), dict(close=12.1, rsi_14=90.0, sigma=0.0)])
def test_combined_rule_stays_silent(spark, row):
    assert alerts(spark, R.combined_rule, **row) == []


def test_single_rules(spark):
    (up,) = alerts(spark, R.vwap_rule, close=12.5)
    assert (up["alert_type"], up["threshold"], up["message"]) == ("VWAP_BREAKOUT_UP", 12.0, "HPG vượt VWAP +2.0σ (giá 12.50 > band 12.00)")
    (down,) = alerts(spark, R.vwap_rule, R.AlertConfig(band_mode="pct"), close=9.0)
    assert (down["alert_type"], down["message"]) == ("VWAP_BREAKDOWN", "HPG breakdown ↓ VWAP -10.0%")
    (rsi,) = alerts(spark, R.rsi_rule, rsi_14=85.0)
    assert (rsi["severity"], rsi["message"]) == ("CRITICAL", "HPG RSI=85.0 — quá mua (cực đoan!)")
    (volume,) = alerts(spark, R.volume_rule, volume_ratio=5.0)
    assert (volume["severity"], volume["message"]) == ("CRITICAL", "HPG KL đột biến 5.0x trung bình (cực đoan!)")


def test_stream_and_column_rules_agree(spark):
    cfg = R.AlertConfig()
    for price in (7.0, 10.0, 13.0):
        for rsi in (None, 10.0, 50.0, 90.0):
            for ratio in (None, 1.0, 4.0):
                got = alerts(spark, R.combined_rule, close=price, rsi_14=rsi, volume_ratio=ratio)
                assert detector.combined_kind(detector.band_side(price, 10.0, 1.0, cfg), rsi, ratio, cfg) == (got[0]["alert_type"] if got else None)


def test_revision_replaces_its_contribution():
    s = detector._Session(None)
    for t, price, volume in ((1, 10.0, 5.0), (2, 20.0, 5.0), (1, 30.0, 5.0)):
        s.add_to_session(t, "2024-01-02", price, volume)
    assert s.band("2024-01-02")[0] == pytest.approx(25.0)
    assert detector._Session(s.saved()).band("2024-01-02") == s.band("2024-01-02")
    s.add_to_session(9, "2024-01-03", 7.0, 1.0)
    s.add_to_session(2, "2024-01-02", 30.0, 5.0)  # a late revision of yesterday
    assert s.band("2024-01-02")[0] == pytest.approx(30.0) and s.band("2024-01-03")[0] == 7.0
    s.add_to_session(20, "2024-01-04", 8.0, 1.0)
    s.add_to_session(3, "2024-01-02", 1.0, 1.0)  # that session is over
    assert s.band("2024-01-02") == (None, None) and s.band("2024-01-03")[0] == 7.0


class _State:
    """What a keyed state offers, without a stream."""

    def __init__(self):
        self.value, self.hasTimedOut, self.timeout = None, False, None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value

    def setTimeoutTimestamp(self, ms):
        self.timeout = ms

    def getCurrentWatermarkMs(self):
        return 0

    def remove(self):
        self.value = None


def test_an_idle_symbol_loses_its_state():
    import pandas as pd

    step, state = detector._on_candles(R.AlertConfig(), ["COMBINED"], 2.0), _State()
    row = {"symbol": "A", "candle_time": datetime(2024, 1, 2, 10), "t": 1, "r": 1, "day": "2024-01-02", "inside": True, "typical": 5.0, "close": 5.0, "volume": 1.0, "warm": False}
    assert not list(step(("A",), iter([pd.DataFrame([row])]), state))
    assert state.exists and state.timeout == 7_200_000 + 0
    state.hasTimedOut = True
    assert not list(step(("A",), iter([]), state)) and not state.exists


def test_single_rules_reach_the_older_table_and_warm_up_is_silent(spark, tmp_path):
    cfg = R.AlertConfig(sigma_k=1.0, rsi_period=5, volume_lookback=8, rsi_overbought=55.0, rsi_oversold=45.0, volume_spike=2.0, cooldown_seconds=7200)
    rules = (R.vwap_rule, R.rsi_rule, R.volume_rule, R.combined_rule)
    parsed = ST.candle_stream(messages(spark).select("value")).cache()
    cut = datetime(2024, 1, 2, 11)
    stored, landing, out = str(tmp_path / "stored"), str(tmp_path / "in"), str(tmp_path / "out")
    parsed.where(F.col("candle_time") < F.lit(cut)).coalesce(1).write.parquet(stored)
    messages(spark).where(F.col("candle_time") >= F.lit(cut)).select("value").coalesce(1).write.text(landing)
    warm = spark.readStream.schema(parsed.schema).parquet(stored)
    stream = ST.candle_stream(ST.message_lines(spark, landing))
    detector.sink_alerts(detector.detect_alerts(stream, cfg, rules, warm), out, f"{out}/checkpoint").awaitTermination()
    columns = ["alert_time", "symbol", "rule_name", "alert_type", "severity", "message"]
    got = sorted(map(tuple, spark.read.parquet(f"{out}/alerts_v2").select(*columns).collect()))
    found = R.evaluate_rules(enrich_candles(parsed, cfg), rules, cfg).where(F.col("alert_time") >= F.lit(cut))
    want = sorted(map(tuple, apply_cooldown(found, cfg.cooldown_seconds).select(*columns).collect()))
    assert got == want and len({g[2] for g in got}) == 4
    older = spark.read.parquet(f"{out}/alerts").collect()
    assert len(older) == sum(g[2] == "VWAP" for g in got) > 0


@pytest.mark.parametrize("text", ['{"symbol":"B","time":1,"close":"abc"}', '{"symbol":"B","time":1,"close":5.0,"volume":7', '{"symbol":"B","time":"x","close":5.0}', "", "[]"])
def test_broken_messages_are_skipped(spark, text):
    lines = spark.createDataFrame([(text,), ('{"symbol":"A","time":1,"close":5.0}',)], "value string")
    assert [r["symbol"] for r in ST.candle_stream(lines).collect()] == ["A"]


def messages(spark, n=260):
    start = datetime(2024, 1, 2, 9, 0)
    rows = []
    for i in range(n):
        t = start + timedelta(minutes=i)
        price = 50 + (i * 37 % 23) + (15 if i % 40 > 30 else 0)
        rows.append(("HPG" if i % 2 else "FPT", t, float(price), 10 + (i * 13 % 50) + (200 if i % 45 == 0 else 0)))
    df = spark.createDataFrame(rows, "symbol string, candle_time timestamp, close double, volume bigint")
    return df.select("candle_time", F.to_json(F.struct(
        F.date_format("candle_time", "yyyy-MM-dd'T'HH:mm:ss").alias("received_at"), "symbol", F.lit("1").alias("resolution"),
        F.col("close").alias("open"), F.col("close").alias("high"), F.col("close").alias("low"), "close", "volume",
        F.lit("STOCK").alias("type"), F.unix_seconds("candle_time").alias("time"))).alias("value"))


@pytest.mark.parametrize("slices", [1, 3])
def test_stream_equals_replay_and_restarts_clean(spark, tmp_path, slices):
    cfg = R.AlertConfig(sigma_k=1.0, rsi_overbought=55.0, rsi_oversold=45.0, volume_spike=2.0)
    all_messages = messages(spark).cache()
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    bounds = [datetime(2024, 1, 2, 9) + timedelta(minutes=300 * i // slices) for i in range(slices + 1)]
    for low, high in zip(bounds, bounds[1:]):
        part = all_messages.where((F.col("candle_time") >= F.lit(low)) & (F.col("candle_time") < F.lit(high))).select("value")
        part.union(spark.createDataFrame([("{broken",)], "value string")).coalesce(1).write.mode("append").text(landing)
        # Each slice is one run; the next starts from the checkpoint.
        stream = ST.candle_stream(ST.message_lines(spark, landing))
        detector.sink_alerts(detector.detect_alerts(stream, cfg), out, f"{out}/checkpoint").awaitTermination()
    columns = ["alert_time", "symbol", "alert_type", "severity", "message"]
    got = sorted(map(tuple, spark.read.parquet(f"{out}/alerts_v2").select(*columns).collect()))
    want = sorted(map(tuple, replay_alerts(ST.candle_stream(all_messages.select("value")), cfg).select(*columns).collect()))
    assert got == want and len(got) > 5


def test_a_candle_from_the_future_silences_nobody(spark, tmp_path):
    cfg = R.AlertConfig(sigma_k=1.0, rsi_overbought=55.0, rsi_oversold=45.0, volume_spike=2.0)
    all_messages = messages(spark).cache()
    start = datetime(2024, 1, 2, 9)
    ahead = all_messages.limit(1).select(F.to_json(F.struct(
        F.lit("2024-01-02T09:00:00").alias("received_at"), F.lit("FPT").alias("symbol"), F.lit("1").alias("resolution"),
        *[F.lit(50.0).alias(c) for c in ("open", "high", "low", "close")], F.lit(5).alias("volume"), F.lit("STOCK").alias("type"),
        F.unix_seconds(F.lit(start + timedelta(days=400)).cast("timestamp")).alias("time"))).alias("value"))
    counts = {}
    for name, extra in (("with", ahead), ("without", ahead.limit(0))):
        landing, out, seen = str(tmp_path / name / "in"), str(tmp_path / name / "out"), []
        for i in range(3):
            low, high = (start + timedelta(minutes=90 * k) for k in (i, i + 1))
            part = all_messages.where((F.col("candle_time") >= F.lit(low)) & (F.col("candle_time") < F.lit(high))).select("value")
            (part.union(extra) if i == 0 else part).coalesce(1).write.mode("append").text(landing)
            stream = ST.candle_stream(ST.message_lines(spark, landing))
            detector.sink_alerts(detector.detect_alerts(stream, cfg), out, f"{out}/checkpoint").awaitTermination()
            seen.append(spark.read.parquet(f"{out}/alerts_v2").count())
        counts[name] = seen
    assert counts["with"] == counts["without"] and counts["with"][0] < counts["with"][2]
    candles = ST.candle_stream(all_messages.select("value").union(ahead))
    assert detector.set_aside(candles).count() == 1
