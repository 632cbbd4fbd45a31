"""Latency and throughput of the candle stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.operators.quantiles import exact_quantiles

# Histogram edges in milliseconds.
LATENCY_EDGES = (500, 1000, 1500, 2000, 3000)


def latency_ms(start: str = "candle_time", end: str = "received_at") -> Column:
    return F.timestamp_diff("MILLISECOND", F.col(start), F.col(end))


def with_latency(candles: DataFrame) -> DataFrame:
    return candles.withColumn("latency_ms", latency_ms())


def on_day(df: DataFrame, column: str, day: str) -> DataFrame:
    return df.where(F.to_date(column) == F.lit(day).cast("date"))


def recent(candles: DataFrame, now: str, minutes: int) -> DataFrame:
    """Candles of the day of ``now`` from the trailing window."""
    moment = F.lit(now).cast("timestamp")
    return candles.where(
        (F.to_date("candle_time") == F.to_date(moment))
        & (F.col("candle_time").cast("timestamp") >= moment - F.make_dt_interval(mins=F.lit(minutes)))
    )


def _quantiles(df: DataFrame, by: Sequence[str], names: dict[str, float], approximate: bool) -> DataFrame:
    if approximate:
        return df.groupBy(*by).agg(
            *[F.percentile_approx("latency_ms", p).cast("double").alias(n) for n, p in names.items()]
        )
    return exact_quantiles(df, by, "latency_ms", list(names.values()), list(names))


def latency_summary(candles: DataFrame, approximate: bool = False) -> DataFrame:
    """Count, mean, p50, p95, p99, min and max of the latency over all rows; one row also where there are none."""
    rows = with_latency(candles).select("latency_ms")
    basic = rows.agg(
        F.count(F.lit(1)).alias("total"), F.round(F.avg("latency_ms"), 1).alias("avg_ms"),
        F.min("latency_ms").cast("double").alias("min_ms"), F.max("latency_ms").cast("double").alias("max_ms"),
    ).withColumn("_all", F.lit(1))
    marks = _quantiles(rows, [], {"p50_ms": 0.5, "p95_ms": 0.95, "p99_ms": 0.99}, approximate).withColumn("_all", F.lit(1))
    return basic.join(marks, "_all", "left").select(
        "total", "avg_ms", *[F.round(c, 1).alias(c) for c in ("p50_ms", "p95_ms", "p99_ms")], "min_ms", "max_ms"
    )


def latency_series(candles: DataFrame, approximate: bool = False, digits: int = 1) -> DataFrame:
    """Count, mean and p95 per minute of receipt."""
    rows = with_latency(candles).select(F.date_trunc("minute", "received_at").alias("minute"), "latency_ms")
    basic = rows.groupBy("minute").agg(
        F.count(F.lit(1)).alias("msg_count"), F.round(F.avg("latency_ms"), digits).alias("avg_ms")
    )
    marks = _quantiles(rows, ["minute"], {"p95_ms": 0.95}, approximate)
    return basic.join(marks, "minute", "left").select(
        "minute", "msg_count", "avg_ms", F.round("p95_ms", digits).alias("p95_ms")
    )


def latency_bucket(value: Column, edges: Sequence[int] = LATENCY_EDGES, dash: str = "–") -> Column:
    out = F.when(value < edges[0], f"<{edges[0]}ms")
    for low, high in zip(edges, edges[1:]):
        out = out.when(value < high, f"{low}{dash}{high}ms")
    return out.otherwise(f">{edges[-1]}ms")


def latency_histogram(candles: DataFrame, dash: str = "–") -> DataFrame:
    bucket = latency_bucket(F.col("latency_ms"), dash=dash).alias("bucket")
    return with_latency(candles).groupBy(bucket).agg(F.count(F.lit(1)).alias("cnt"))


def throughput(candles: DataFrame, now: str) -> DataFrame:
    """Messages per second over the trailing minute."""
    moment = F.lit(now).cast("timestamp")
    received = F.col("received_at").cast("timestamp")
    last = candles.where(
        (F.to_date("candle_time") == F.to_date(moment)) & (received >= moment - F.make_dt_interval(mins=F.lit(1)))
    )
    return last.agg((F.count(F.lit(1)) / 60.0).alias("mps"))


def daily_counts(candles: DataFrame, alerts: DataFrame) -> DataFrame:
    """Candles and alerts per local day."""
    a = candles.groupBy(F.to_date("candle_time").alias("day")).agg(F.count(F.lit(1)).alias("candles"))
    b = alerts.groupBy(F.to_date("alert_time").alias("day")).agg(F.count(F.lit(1)).alias("alerts"))
    return a.join(b, "day", "full_outer").select(
        "day", F.coalesce("candles", F.lit(0)).alias("candles"), F.coalesce("alerts", F.lit(0)).alias("alerts")
    )


def latest_message(candles: DataFrame) -> DataFrame:
    """The message received last and its latency."""
    return with_latency(candles).orderBy(
        F.col("received_at").desc(), F.col("symbol"), F.col("candle_time").desc()
    ).limit(1).select("symbol", "candle_time", "received_at", "latency_ms")


def symbols_on_day(candles: DataFrame, day: str) -> DataFrame:
    return on_day(candles, "candle_time", day).select("symbol").distinct().orderBy("symbol")
