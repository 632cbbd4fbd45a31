"""Streaming sources of JSON messages, and the same parser for batch frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from candlewright.schemas import CANDLE_MESSAGE, TRADE_MESSAGE

BROKEN = "_broken"


def message_lines(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """JSON lines dropped into a folder, as a stream of ``value``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """The same from a Kafka topic; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def parse_messages(lines: DataFrame, schema: StructType, needed: list[str]) -> DataFrame:
    """Typed rows of JSON messages; a message that is broken, holds a value of another type or lacks a needed field is skipped."""
    checked = StructType([*schema.fields, StructField(BROKEN, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
    parsed = lines.select(F.from_json("value", checked, options).alias("_m")).select("_m.*").where(F.col(BROKEN).isNull()).drop(BROKEN)
    for column in needed:
        parsed = parsed.where(F.col(column).isNotNull())
    return parsed


def receipt_time(column: str = "received_at") -> Column:
    """Milliseconds precision; text without an offset is local time."""
    return F.date_trunc("millisecond", F.try_to_timestamp(F.col(column)))


def shape_candles(messages: DataFrame) -> DataFrame:
    """Epoch seconds to candle_time, text to received_at, ``type`` to market_type."""
    return messages.select(
        receipt_time().alias("received_at"), F.timestamp_seconds("time").alias("candle_time"), "symbol",
        "resolution", F.col("type").alias("market_type"), "open", "high", "low", "close", "volume", "lastUpdated",
    )


def shape_trades(messages: DataFrame) -> DataFrame:
    return messages.select(
        receipt_time().alias("received_at"), "symbol", "price", "quantity", "total_volume", "board_id", "market_id"
    )


def candle_stream(lines: DataFrame) -> DataFrame:
    return shape_candles(parse_messages(lines, CANDLE_MESSAGE, ["symbol", "time"]))


def trade_stream(lines: DataFrame) -> DataFrame:
    return shape_trades(parse_messages(lines, TRADE_MESSAGE, ["symbol", "received_at"]))
