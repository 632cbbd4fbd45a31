"""Archive, purge and expiry of stream tables."""

from __future__ import annotations

from datetime import date, timedelta
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.sources.files import delete, heal, partition_values, swap_partitions


def archived_days(spark, root: str) -> DataFrame:
    """Days that have an archive; bounded by the calendar, read from directory names."""
    days = [(d,) for d in partition_values(spark, root, "date")]
    return spark.createDataFrame(days, "date string")


def archive_plan(table: DataFrame, column: str, archived: DataFrame, overwrite: bool = False) -> DataFrame:
    """(date, n, status) of every day in the table: write, or skipped where archived already."""
    counted = table.where(F.col(column).isNotNull()).groupBy(F.date_format(column, "yyyy-MM-dd").alias("date")).agg(
        F.count(F.lit(1)).alias("n")
    )
    known = archived.select("date").distinct().withColumn("_have", F.lit(True))
    skip = F.col("_have").isNotNull() & F.lit(not overwrite)
    return counted.join(known, "date", "left").select(
        "date", "n", F.when(skip, "skipped").otherwise("archived").alias("status")
    )


def archive(table: DataFrame, column: str, root: str, day: str | None = None, overwrite: bool = False) -> DataFrame:
    """Copy whole days to ``date=YYYY-MM-DD`` folders; returns (date, n, status) per day.

    Days archived before are skipped. A single day without rows is reported as empty. Of a table partitioned by ``date``
    a single day opens its own folder only.
    """
    spark = table.sparkSession
    rows = table if day is None else table.where(F.to_date(column) == F.lit(day).cast("date"))
    if "date" in table.columns:
        rows = (rows if day is None else rows.where(F.col("date").cast("string") == day)).drop("date")
    archived = archived_days(spark, root)
    plan = archive_plan(rows, column, archived, overwrite)
    dated = rows.where(F.col(column).isNotNull()).withColumn("date", F.date_format(column, "yyyy-MM-dd"))
    if not overwrite:
        dated = dated.join(archived, "date", "left_anti")
    spread = dated.hint("rebalance", "date").sortWithinPartitions("date", column)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(root)
    if day is None:
        return plan
    asked = spark.range(1).select(F.lit(day).alias("date"))
    return asked.join(plan, "date", "left").select(
        "date", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("status", F.lit("empty")).alias("status")
    )


def purge_plan(table: DataFrame, column: str, archived: DataFrame, cutoff: date) -> DataFrame:
    """(date, n, status) of days before the cutoff: purged only where archived, else kept."""
    old = table.where(F.to_date(column) < F.lit(cutoff)).groupBy(
        F.date_format(column, "yyyy-MM-dd").alias("date")
    ).agg(F.count(F.lit(1)).alias("n"))
    known = archived.select("date").distinct().withColumn("_have", F.lit(True))
    return old.join(known, "date", "left").select(
        "date", "n", F.when(F.col("_have"), "purged").otherwise("kept").alias("status")
    )


def purged(table: DataFrame, column: str, archived: DataFrame, cutoff: date) -> DataFrame:
    """The rows that stay: recent days, and old days without an archive."""
    gone = archived.select(F.col("date").cast("date").alias("_d")).where(F.col("_d") < F.lit(cutoff)).distinct()
    return table.join(gone, F.to_date(F.col(column)) == F.col("_d"), "left_anti")


def purge_partitions(spark, path: str, archive_root: str, today: date, retention_days: int = 30) -> dict[str, str]:
    """Drop the day folders older than the retention that have an archive; status per old day.

    Works on a table partitioned by ``date``. The list is one entry per day.
    """
    cutoff = (today - timedelta(days=retention_days)).isoformat()
    have = set(partition_values(spark, archive_root, "date"))
    status = {}
    for day in partition_values(spark, path, "date"):
        if day >= cutoff:
            continue
        status[day] = "purged" if day in have else "kept"
        if day in have:
            delete(spark, f"{path.rstrip('/')}/date={day}")
    return status


def unexpired(table: DataFrame, column: str, today: date, days: int = 45) -> DataFrame:
    """Rows whose day lies within the time to live."""
    return table.where(F.to_date(column) + F.expr(f"interval {int(days)} days") > F.lit(today))


def span_of(value: str) -> tuple[date, date]:
    """First and last day of a partition named by a day or a month."""
    first = date.fromisoformat(value if len(value) == 10 else f"{value}-01")
    return first, first if len(value) == 10 else (first.replace(day=28) + timedelta(days=4)).replace(day=1) - timedelta(days=1)


def expire(spark, path: str, column: str, today: date, days: int = 45, partition: str = "date") -> dict[str, str]:
    """Remove the rows past their time to live from a table partitioned by day or month; status per partition touched.

    Whole expired partitions are dropped by name, unread. The one partition that lies across the limit is written anew
    without its expired rows and swapped in. Running it again changes nothing; rows without a readable time go with
    their partition.
    """
    heal(spark, path)
    limit = today - timedelta(days=days)  # the last day that has expired
    status = {}
    for value in partition_values(spark, path, partition):
        try:
            first, last = span_of(value)
        except ValueError:
            continue  # not a day, such as the partition of nulls
        if last <= limit:
            delete(spark, f"{path.rstrip('/')}/{partition}={value}")
            status[value] = "dropped"
        elif first <= limit:
            table = spark.read.parquet(path)
            part = table.where(F.col(partition).cast("string") == value)
            expired = F.coalesce(F.to_date(column) <= F.lit(limit), F.lit(False))
            if part.where(expired).isEmpty():
                continue
            staged = f"{path.rstrip('/')}__{uuid4().hex}"
            part.where(~expired).write.partitionBy(partition).parquet(staged)
            if partition_values(spark, staged, partition):
                swap_partitions(spark, staged, path)
            else:
                delete(spark, staged)
                delete(spark, f"{path.rstrip('/')}/{partition}={value}")
            status[value] = "rewritten"
    return status
