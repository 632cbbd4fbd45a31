"""Daily bars from intraday prints, and the latest revision of streamed candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.cleanse import require_columns, to_datetime_any, to_double
from candlewright.schemas import RAW_OHLC_COLUMNS


def read_prints(df: DataFrame) -> DataFrame:
    """Typed intraday prints: unreadable times and null symbols dropped, null volume counts as 0."""
    require_columns(df, RAW_OHLC_COLUMNS, "intraday table")
    typed = df.withColumn("time", to_datetime_any("time", df.schema["time"].dataType))
    return (
        typed.where(F.col("symbol").isNotNull() & F.col("time").isNotNull())
        .withColumns({c: to_double(c) for c in ("open", "high", "low", "close")})
        .withColumn("volume", F.coalesce(F.col("volume").try_cast("bigint"), F.lit(0)))
        .withColumn("trade_date", F.to_date("time"))
    )


def daily_bars(prints: DataFrame, order: str | Column = "time") -> DataFrame:
    """OHLCV per (symbol, day).

    ``order`` is one fixed-width value giving the order inside the day, so that first and last open
    and close stay in a hash aggregate whose map-side part shrinks a hot symbol before the shuffle.
    """
    rank = F.col(order) if isinstance(order, str) else order
    return read_prints(prints).groupBy("symbol", "trade_date").agg(
        F.min_by("open", rank).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", rank).alias("close"),
        F.sum("volume").alias("volume"),
    )


def latest_revisions(
    candles: DataFrame,
    values: Sequence[str] = ("open", "high", "low", "close", "volume"),
) -> DataFrame:
    """One row per (symbol, candle_time): the values received last."""
    return candles.groupBy("symbol", "candle_time").agg(
        *[F.max_by(v, "received_at").alias(v) for v in values],
        F.max("received_at").alias("received_at"),
    )


def last_candles(candles: DataFrame, size: int = 50) -> DataFrame:
    """The last ``size`` candles of every symbol, each in the revision received last.

    Spark limits a symbol to ``size`` rows in every map task before the shuffle, so a hot symbol isn't sorted in one task.
    """
    values = [c for c in candles.columns if c not in ("symbol", "candle_time", "received_at")]
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.col("candle_time").desc()))
    return latest_revisions(candles, values).withColumn("_k", newest).where(F.col("_k") <= size).drop("_k")
