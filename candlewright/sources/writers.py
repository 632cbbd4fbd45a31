"""Write modes. None rewrites more than the partitions it touches."""

from __future__ import annotations

from collections.abc import Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType, TimestampType

from candlewright.functions.cleanse import drop_audit_columns, normalise_summary, to_datetime_any
from candlewright.sources.files import delete, exists, heal, make_folder, partition_values, swap_in, swap_partitions

DATE_MIN, DATE_MAX = "1970-01-01", "2149-06-06"
DAY_PARTITIONS = ["year", "month", "day"]


class KeyLossError(ValueError):
    """A merge would lose keys that exist already."""


def write_if_absent(df: DataFrame, path: str) -> None:
    df.write.mode("ignore").parquet(path)


def replace_snapshot(df: DataFrame, path: str) -> bool:
    """Replace a table by a new snapshot; an empty snapshot leaves the old one. True if written."""
    if df.isEmpty():
        return False
    staged = f"{path.rstrip('/')}__{uuid4().hex}"
    df.write.parquet(staged)
    swap_in(df.sparkSession, staged, path)
    return True


def dedup_keys(columns: Sequence[str], primary: Sequence[str], fallback: Sequence[str]) -> list[str]:
    """The primary keys if all are there, else the fallback keys, never anything looser."""
    for keys in (primary, fallback):
        if set(keys) <= set(columns):
            return list(keys)
    raise ValueError(f"cannot dedup safely: need {list(primary)} or {list(fallback)}, have {sorted(columns)}")


def existing_keys(columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """The looser choice: whichever of the keys exist."""
    return [k for k in keys if k in columns]


def common_columns(new: DataFrame, old: DataFrame) -> list[str]:
    return [c for c in new.columns if c in old.columns]


def merge_rows(
    new: DataFrame, old: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), union: bool = False, transform=None, layout: Sequence[str] = ()
) -> DataFrame:
    """New and old rows over their common columns, or all columns with ``union``, one per key, new before old.

    ``transform`` changes the rows before keys are compared, so keys that it makes equal meet.

    ``order`` ranks rows of the same side. Each key is limited to one row per map task before the
    shuffle, so repeated copies of a key do not meet in one task. With ``layout``, the keys in the order of a table,
    rows come out in ranges of it, by the same shuffle.
    """
    if not union:
        shared = common_columns(new, old)
        new, old = new.select(*shared), old.select(*shared)
    both = new.withColumn("_side", F.lit(0)).unionByName(old.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    if transform is not None:
        both = transform(both)
    columns = [c for c in both.columns if c != "_side"]
    rest = [F.col(c).asc_nulls_last() for c in columns if c not in keys]
    rank = F.row_number().over(Window.partitionBy(*(layout or keys)).orderBy("_side", *order, *rest))
    if layout:
        both = both.repartitionByRange(*layout)
    return both.withColumn("_rank", rank).where("_rank = 1").drop("_rank", "_side")


def lost_keys(old: DataFrame, merged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of ``old`` that ``merged`` does not hold; a null key compares as equal to null."""
    renamed = {k: f"_k{i}" for i, k in enumerate(keys)}
    condition = F.lit(True)
    for k, other in renamed.items():
        condition = condition & F.col(k).eqNullSafe(F.col(other))
    kept = merged.select(*keys).withColumnsRenamed(renamed)
    return old.select(*keys).join(kept, condition, "left_anti").distinct()


def append_merge(
    new: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    order: Sequence[Column] = (),
    guard: bool = False,
    transform=None,
    staged: bool = False,
) -> None:
    """Merge new rows into a table, the new row winning per key.

    The new rows are written aside once and read from there, unless they are read from such a place already (``staged``). With partitions only the affected ones are read, by their
    values, and overwritten. Columns: those in common; with ``guard`` all of either side. Where a partitioned table
    loses or gains a column, all of its partitions are rewritten, so that they keep one schema. With ``guard`` nothing is
    written if an existing key would vanish. ``transform`` keeps the columns that it is given. An empty frame changes nothing.
    """
    spark = new.sparkSession
    parts = list(partition_by)
    sort = [*parts, *[k for k in keys if k not in parts]]
    # Where a partition follows from the key, the ranges in which the rows are written hold a key whole: one shuffle for both.
    layout = sort if parts and set(parts) <= set(keys) else []
    aside = None if staged else f"{path.rstrip('/')}__{uuid4().hex}"
    if aside:
        new.write.parquet(aside)
    try:
        if aside:
            new = spark.read.schema(new.schema).parquet(aside)
        if new.isEmpty():
            return
        if not exists(spark, path):
            _write(merge_rows(new, new.limit(0), keys, order, transform=transform, layout=layout), path, parts, sort, bool(layout))
            return
        # All partitions have one schema, see above: no need to open every file for it.
        old = spark.read.option("mergeSchema", not parts).parquet(path)
        if parts:
            # Partition values are read in the type of the new rows, so that "01" does not become 1.
            types = [new.schema[f.name] if f.name in parts and f.name in new.columns else f for f in old.schema.fields]
            old = spark.read.schema(StructType(types)).parquet(path)
            alike = set(new.columns) == set(old.columns) or guard and set(new.columns) <= set(old.columns)
            if alike:
                # One row per partition of the new rows; as literals they prune the listing of the old ones.
                touched = new.select(*parts).distinct().collect()
                for p in parts:
                    old = old.where(F.col(p).isin([r[p] for r in touched if r[p] is not None]) | (F.col(p).isNull() if any(r[p] is None for r in touched) else F.lit(False)))
                old = old.join(new.select(*parts).distinct(), parts, "left_semi") if len(parts) > 1 else old
        merged = merge_rows(new, old, keys, order, union=guard, transform=transform, layout=layout)
        if guard:
            lost = lost_keys(old, merged, keys)
            if not lost.isEmpty():
                raise KeyLossError(f"merge into {path} would lose keys, e.g. {lost.first()}")
        if parts and not alike:
            whole = f"{path.rstrip('/')}__{uuid4().hex}"
            _write(merged, whole, parts, sort, bool(layout))
            swap_in(spark, whole, path)
        else:
            _write(merged, path, parts, sort, bool(layout))
    finally:
        if aside:
            delete(spark, aside)


def _write(df: DataFrame, path: str, parts: list[str], sort: list[str], ranged: bool = False) -> None:
    """Overwrite the partitions present in ``df``, or the whole table by a swap. ``ranged``: the rows lie in ranges of ``sort`` already."""
    if parts:
        # Rebalancing splits a partition that holds much and packs many small ones into one task.
        spread = df if ranged else df.hint("rebalance", *parts)
        spread.sortWithinPartitions(*sort).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)
        return
    staged = f"{path.rstrip('/')}__{uuid4().hex}"
    df.repartitionByRange(*sort).sortWithinPartitions(*sort).write.parquet(staged)
    swap_in(df.sparkSession, staged, path)


def append_batch(new: DataFrame, path: str, label: str, primary: Sequence[str], fallback: Sequence[str]) -> None:
    """Add one incremental batch without reading the others; the same label is replaced."""
    if new.isEmpty():
        return
    try:
        keys = dedup_keys(new.columns, primary, fallback)
    except ValueError:
        keys = []
    rows = merge_rows(new, new.limit(0), keys) if keys else new
    rows.withColumn("batch_label", F.lit(label)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("batch_label").parquet(path)


def with_day_partitions(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Zero-padded year, month and day texts from the first of time, date and tradingDate.

    A time with a zone counts on the local day of the session, or of ``zone``. Rows without a
    readable time are dropped.
    """
    source = next((c for c in ("time", "date", "tradingDate") if c in df.columns), None)
    if source is None:
        raise ValueError("no time, date or tradingDate column to partition by")
    dtype = df.schema[source].dataType
    moment = to_datetime_any(source, dtype)
    if zone and isinstance(dtype, TimestampType):
        moment = F.convert_timezone(F.current_timezone(), F.lit(zone), moment.cast("timestamp_ntz"))
    out = df.withColumn("_moment", moment).where(F.col("_moment").isNotNull())
    return out.withColumns({
        name: F.date_format("_moment", pattern) for name, pattern in zip(DAY_PARTITIONS, ("yyyy", "MM", "dd"))
    }).drop("_moment")


def write_by_day(df: DataFrame, path: str, keys: Sequence[str] = ("symbol", "time"), append: bool = True) -> None:
    """One partition per local day, merged by key or, without ``append``, kept where it exists."""
    dated = with_day_partitions(df)
    spark = df.sparkSession
    if not append and exists(spark, path):
        have = spark.read.parquet(path).select(*DAY_PARTITIONS).distinct()
        dated = dated.join(have, DAY_PARTITIONS, "left_anti")
    append_merge(dated, path, [*DAY_PARTITIONS, *existing_keys(dated.columns, keys)], DAY_PARTITIONS)


def merge_summary_days(new: DataFrame, path: str, now: Column | None = None) -> None:
    """Merge daily fundamentals by symbol inside each day; ingested_at is set where it is missing."""
    stamp = F.date_format(now if now is not None else F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssZ")
    tidy = normalise_summary(new)
    stamped = tidy.withColumn("ingested_at", F.coalesce(F.col("ingested_at").cast("string"), stamp))
    write_by_day(stamped, path, keys=("symbol",))


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """Target columns in order: missing ones null, others left out, dates clamped to the storable range."""
    low, high = F.lit(DATE_MIN).cast("date"), F.lit(DATE_MAX).cast("date")
    columns = []
    for field in schema.fields:
        if field.name not in df.columns:
            column = F.lit(None).cast(field.dataType)
        else:
            column = F.col(field.name).try_cast(field.dataType)
            if isinstance(field.dataType, DateType):
                column = F.when(column.isNotNull(), F.greatest(F.least(column, high), low))
        columns.append(column.alias(field.name))
    return df.select(*columns)


def load_table(df: DataFrame, path: str, schema: StructType) -> DataFrame:
    """Full refresh of a serving table; returns (source_rows, loaded_rows, verified)."""
    spark = df.sparkSession
    replace_snapshot(align_to_schema(df, schema), path)
    loaded = spark.read.schema(schema).parquet(path)
    source = df.agg(F.count(F.lit(1)).alias("source_rows"))
    return source.withColumn("loaded_rows", loaded.agg(F.count(F.lit(1))).scalar()).withColumn(
        "verified", F.col("source_rows") == F.col("loaded_rows")
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """The row with the highest version per key, further ties broken by the other columns."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in (*keys, version)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(version).desc_nulls_last(), *rest))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


class Store:
    """Named tables under one root. Publishing writes a table behind its gate and reads it back."""

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name.replace('.', '/')}"

    def has(self, name: str) -> bool:
        heal(self.spark, self.path(name))
        return exists(self.spark, self.path(name))

    def read(self, name: str) -> DataFrame:
        heal(self.spark, self.path(name))
        return self.spark.read.parquet(self.path(name))

    def aside(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> tuple[DataFrame, str]:
        """``df`` written beside the table, and where."""
        staged = f"{self.path(name)}__{uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(staged)
        return self.spark.read.schema(df.schema).parquet(staged), staged

    def partitions(self, name: str, column: str) -> list[str]:
        """Partition values of a table in order, from its folders."""
        heal(self.spark, self.path(name))
        return partition_values(self.spark, self.path(name), column)

    def mark(self, name: str, value: str) -> None:
        """Note that work on ``name`` has begun from ``value`` on; the note stays until ``unmark``."""
        make_folder(self.spark, f"{self.root}/_begun/{name}/from={value}")

    def marks(self, name: str) -> list[str]:
        return partition_values(self.spark, f"{self.root}/_begun/{name}", "from")

    def unmark(self, name: str) -> None:
        delete(self.spark, f"{self.root}/_begun/{name}")

    def publish_parts(self, df: DataFrame, name: str, column: str, order: Sequence[str], checks=None, spread: bool = True) -> DataFrame:
        """Replace the partitions of ``column`` that ``df`` holds; inside them rows are range-sorted by ``order``.

        Files then hold short ranges of ``order``, so a reader of one key opens few of them. Written aside and checked
        first; partitions are swapped one by one, so a lost driver leaves whole partitions, older or newer. Rows that
        lie by ``column`` already, as those read from another table of such parts, need no shuffle (``spread=False``): they are
        sorted where they are, and a file holds the rows of the files it was made from.
        """
        from candlewright.quality.gates import GATES
        from candlewright.quality.suite import gate

        checks = GATES.get(name, []) if checks is None else checks
        sort = [column, *order]
        rows = drop_audit_columns(df)
        laid = (rows.repartitionByRange(*sort) if spread else rows).sortWithinPartitions(*sort)
        written, staged = self.aside(laid, name, [column])
        if checks:
            try:
                gate(written.drop(column), checks, name)
            except Exception:
                delete(self.spark, staged)
                raise
        if self.partitions(name, column):
            swap_partitions(self.spark, staged, self.path(name))
        else:
            if not partition_values(self.spark, staged, column):  # no rows at all: a file that holds the schema
                delete(self.spark, staged)
                df.limit(0).write.parquet(staged)
            swap_in(self.spark, staged, self.path(name))
        return self.read(name)

    def publish(self, df: DataFrame, name: str, checks=None) -> DataFrame:
        """Write aside, check what was written, then swap it in: a failing table changes nothing."""
        from candlewright.quality.gates import GATES
        from candlewright.quality.suite import gate

        checks = GATES.get(name, []) if checks is None else checks
        staged = f"{self.path(name)}__{uuid4().hex}"
        drop_audit_columns(df).write.parquet(staged)
        if checks:
            try:
                gate(self.spark.read.parquet(staged), checks, name)
            except Exception:
                delete(self.spark, staged)
                raise
        swap_in(self.spark, staged, self.path(name))
        return self.read(name)
