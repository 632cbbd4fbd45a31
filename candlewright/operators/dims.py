"""Dimensions: cleansing, persistent surrogate keys, slowly changing memberships, the calendar."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.cleanse import (
    clean_symbol,
    clean_text,
    date_key,
    drop_audit_columns,
    is_weekend,
    keep_first,
    require_columns,
    with_date,
)
from candlewright.operators.lookups import lookup_join
from candlewright.schemas import CALENDAR_COLUMNS, SCD_COLUMNS
from candlewright.session import pinned

OPEN_END = date(9999, 12, 31)
WEEKEND_NAME = "Cuối tuần"


def clean_index_info(df: DataFrame) -> DataFrame:
    require_columns(df, ["index_id", "symbol"], "index table")
    out = df.select(
        F.col("index_id").try_cast("bigint").alias("index_id"),
        F.upper(F.trim(F.col("symbol").cast("string"))).alias("index_symbol"),
        clean_text("name").alias("index_name"),
        clean_text("description").alias("description"),
        F.upper(F.trim(F.col("group").cast("string"))).alias("group"),
    ).where(F.col("index_id").isNotNull() & F.col("index_symbol").isNotNull())
    return keep_first(out, ["index_id"], [])


def clean_sector_info(df: DataFrame) -> DataFrame:
    require_columns(df, ["sector_id", "sector"], "sector table")
    out = df.select(
        F.col("sector_id").try_cast("int").alias("sector_id"), clean_text("sector").alias("sector")
    ).where(F.col("sector_id").isNotNull() & F.col("sector").isNotNull())
    return keep_first(out, ["sector_id"], [])


def surrogate_from_source(df: DataFrame, natural: str, surrogate: str, dtype: str = "int") -> DataFrame:
    """Use a source identifier without meaning as the key, in first place."""
    require_columns(df, [natural], "dimension")
    rest = [c for c in df.columns if c not in (natural, surrogate)]
    return df.select(F.col(natural).cast(dtype).alias(surrogate), *rest)


def ordered_numbers(df: DataFrame, column: str) -> DataFrame:
    """(column, _number): the rank from 1 of each row in the order of ``column``, computed in parallel.

    Rows are range-partitioned and numbered inside their partition; the partition sizes, one row per
    partition, give the offsets. The numbered frame is pinned because both branches must see it alike.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = pinned(
        df.select(column).repartitionByRange(parts, column).sortWithinPartitions(column)
        .withColumn("_id", F.monotonically_increasing_id())
    ).select(column, F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(2**33 - 1).alias("_at"))
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    return ranged.join(F.broadcast(offsets), "_part").select(
        column, (F.col("_base") + F.col("_at") + 1).alias("_number")
    )


def new_keys(df: DataFrame, mapping: DataFrame, natural: str) -> DataFrame:
    """Natural keys of ``df`` that the mapping does not hold yet."""
    return (
        df.select(natural).where(F.col(natural).isNotNull()).distinct()
        .join(mapping.select(natural), natural, "left_anti")
    )


def extend_key_map(df: DataFrame, mapping: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """The mapping with new natural keys, in order, numbered on from the largest key in use."""
    top = mapping.agg(F.coalesce(F.max(surrogate), F.lit(0))).scalar()
    added = ordered_numbers(new_keys(df, mapping, natural), natural).select(
        natural, (F.col("_number") + top).cast("int").alias(surrogate)
    )
    return mapping.select(natural, F.col(surrogate).cast("int").alias(surrogate)).unionByName(added)


def assign_surrogate_keys(
    df: DataFrame, mapping: DataFrame, natural: str = "symbol", surrogate: str = "stock_key"
) -> tuple[DataFrame, DataFrame]:
    """(rows with their key in front, updated mapping); keys once given never change."""
    updated = extend_key_map(df, mapping, natural, surrogate)
    rest = [c for c in df.columns if c != surrogate]
    keyed = lookup_join(df.select(*rest), updated, [natural], "left").select(surrogate, *rest)
    return keyed, updated


def merge_memberships(history: DataFrame | None, snapshot: DataFrame, run_date: date) -> DataFrame:
    """Slowly changing membership (type 2) after one more snapshot.

    Closed rows stay. An open row still in the snapshot stays as it is, one no longer there is
    closed the day before ``run_date``, a new pair is opened. A row closed on the day it was opened
    never held and is left out.
    """
    require_columns(snapshot, ["symbol", "index_id"], "membership snapshot")
    key = ["symbol", "index_id"]
    current = snapshot.select(*key).distinct()
    opened = [
        F.lit(run_date).alias("effective_from"), F.lit(OPEN_END).alias("effective_to"),
        F.lit(1).cast("byte").alias("is_current"),
    ]
    if history is None:
        return current.select(*key, *opened)
    typed = history.withColumns({c: F.col(c).try_cast("date") for c in ("effective_from", "effective_to")})
    flag = F.col("is_current").try_cast("byte") if "is_current" in history.columns else (
        F.col("effective_to") == F.lit(OPEN_END)
    ).cast("byte")
    typed = typed.withColumn("is_current", flag).select(*SCD_COLUMNS)
    closed = typed.where("is_current = 0")
    # One full join of open rows and snapshot decides keep, close and open together.
    old = typed.where("is_current = 1").withColumn("_old", F.lit(True))
    both = old.join(current.withColumn("_new", F.lit(True)), key, "full_outer")
    gone, fresh = F.col("_new").isNull(), F.col("_old").isNull()
    merged = both.select(
        *key,
        F.when(fresh, F.lit(run_date)).otherwise(F.col("effective_from")).alias("effective_from"),
        F.when(fresh, F.lit(OPEN_END)).when(gone, F.date_sub(F.lit(run_date), 1))
        .otherwise(F.col("effective_to")).alias("effective_to"),
        F.when(gone, F.lit(0)).otherwise(F.lit(1)).cast("byte").alias("is_current"),
    )
    return closed.unionByName(merged).where(
        F.coalesce(F.col("effective_to") >= F.col("effective_from"), F.lit(True))
    ).distinct()


def membership_changes(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Open pairs marked kept or removed, and snapshot pairs marked added."""
    key = ["symbol", "index_id"]
    old = history.where("is_current = 1").select(*key).distinct()
    new = snapshot.select(*key).distinct()
    return (
        old.join(new, key, "left_semi").withColumn("change", F.lit("kept"))
        .unionByName(old.join(new, key, "left_anti").withColumn("change", F.lit("removed")))
        .unionByName(new.join(old, key, "left_anti").withColumn("change", F.lit("added")))
    )


def join_calendar_events(calendar: DataFrame, events: DataFrame, column: str = "date") -> DataFrame:
    """Calendar days with their events; a day with several events appears several times."""
    days = drop_audit_columns(with_date(calendar, column))
    named = drop_audit_columns(with_date(events, column))
    return lookup_join_many(days, named, column)


def lookup_join_many(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    extra = [c for c in right.columns if c != column and c not in left.columns]
    return left.join(right.select(column, *extra), column, "left")


def calendar_flags(joined: DataFrame, column: str = "date") -> DataFrame:
    """Replace event_type and is_weekend by is_day_off, name weekends, add cal_year."""
    holiday: Column = F.lit(False)
    if "event_type" in joined.columns:
        holiday = F.coalesce(F.trim(F.col("event_type").cast("string")) != "", F.lit(False))
    weekend = F.col("is_weekend").cast("int") == 1 if "is_weekend" in joined.columns else is_weekend(column)
    name = F.col("event_name") if "event_name" in joined.columns else F.lit(None).cast("string")
    out = joined.withColumnRenamed("week", "cal_week")
    if "cal_year" not in out.columns:
        out = out.withColumn("cal_year", F.year(column).cast("bigint"))
    out = out.withColumns({
        "event_name": F.when(weekend, F.lit(WEEKEND_NAME)).otherwise(name),
        "is_day_off": (holiday | weekend).cast("byte"),
    })
    return out.drop(
        "event_type", "is_weekend", "duration", "day_of_week", "day_name", "month_name", "event_code"
    )


def one_event_per_day(events: DataFrame, column: str = "date") -> DataFrame:
    """The distinct names and types of a day joined in order, so that a calendar day stays one row.

    A day has few event names; they are reduced to distinct ones before they meet.
    """
    kept = with_date(events, column).select(column, "event_name", "event_type").distinct()
    return kept.groupBy(column).agg(
        F.array_join(F.array_sort(F.collect_set("event_name")), "; ").alias("event_name"),
        F.array_join(F.array_sort(F.collect_set("event_type")), "; ").alias("event_type"),
    )


def calendar_days(days: DataFrame, column: str = "date") -> DataFrame:
    """The calendar attributes of distinct days."""
    c = F.col(column)
    return days.select(
        c, F.quarter(c).alias("cal_quarter"), F.month(c).alias("cal_month"), F.weekofyear(c).alias("cal_week")
    )


def publish_calendar(calendar: DataFrame, events: DataFrame) -> DataFrame:
    """date_key and the calendar columns, one row per day."""
    flagged = calendar_flags(join_calendar_events(calendar, one_event_per_day(events)))
    out = flagged.withColumnRenamed("date", "trade_date").select(*CALENDAR_COLUMNS)
    return out.select(date_key("trade_date").alias("date_key"), *CALENDAR_COLUMNS)


def conform_calendar(df: DataFrame) -> DataFrame:
    out = df.withColumnRenamed("date", "trade_date")
    require_columns(out, CALENDAR_COLUMNS, "calendar")
    return out.select(*CALENDAR_COLUMNS)


def clean_company_items(df: DataFrame, columns: Sequence[str], symbol_column: str = "symbol") -> DataFrame:
    """Company events or news: symbol cleaned, public_date read from any encoding, rows distinct."""
    renamed = df.withColumnRenamed(symbol_column, "symbol") if symbol_column != "symbol" else df
    require_columns(renamed, columns, "company items")
    return (
        with_date(renamed, "public_date").withColumn("symbol", clean_symbol("symbol"))
        .select(*columns).where(F.col("symbol").isNotNull()).distinct()
    )
