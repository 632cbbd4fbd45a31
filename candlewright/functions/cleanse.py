"""Column expressions and small frame helpers for cleansing raw tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DataType,
    DateType,
    IntegralType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from candlewright.schemas import RAW_SUMMARY_COLUMNS, RAW_SUMMARY_METRICS


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "frame") -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")


def clean_symbol(column: str | Column) -> Column:
    """Trimmed upper-case text; blank becomes null."""
    text = F.upper(F.trim(_col(column).cast("string")))
    return F.when(text != "", text)


def clean_text(column: str | Column) -> Column:
    return F.trim(_col(column).cast("string"))


def normalise_symbols(df: DataFrame, column: str = "symbol") -> DataFrame:
    """The distinct non-blank symbols of a frame."""
    return df.select(clean_symbol(column).alias(column)).where(F.col(column).isNotNull()).distinct()


def to_date_any(column: str, dtype: DataType) -> Column:
    """Date from a date, epoch milliseconds, a timestamp or the first ten characters of a text."""
    c = F.col(column)
    if isinstance(dtype, DateType):
        return c
    if isinstance(dtype, IntegralType):
        return F.to_date(F.timestamp_millis(c))
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(c)
    text = c.cast("string").substr(1, 10)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def with_date(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    return df.withColumn(name or column, to_date_any(column, df.schema[column].dataType))


def to_datetime_any(column: str, dtype: DataType) -> Column:
    """Timestamp from text, date or timestamp; what cannot be read becomes null."""
    c = F.col(column)
    if isinstance(dtype, StringType):
        return F.try_to_timestamp(c)
    if isinstance(dtype, IntegralType):
        return F.timestamp_millis(c)
    return c if isinstance(dtype, (TimestampType, TimestampNTZType)) else c.cast("timestamp")


def to_double(column: str | Column) -> Column:
    return _col(column).try_cast("double")


def metric_columns(df: DataFrame, metrics: Sequence[str]) -> list[Column]:
    """Each metric as a double, null where the frame lacks it."""
    return [
        (to_double(m) if m in df.columns else F.lit(None).cast("double")).alias(m) for m in metrics
    ]


def coerce_whole_number(df: DataFrame, column: str, drop_invalid: bool = True) -> DataFrame:
    """Whole numbers as bigint; other values are dropped, or nulled on request."""
    if column not in df.columns:
        return df
    number = to_double(column)
    whole = F.when(number % 1 == 0, F.coalesce(F.col(column).try_cast("bigint"), number.try_cast("bigint")))
    out = df.withColumn(column, whole)
    return out.where(F.col(column).isNotNull()) if drop_invalid else out


def decode_utf8(column: str | Column) -> Column:
    """Text of UTF-8 bytes with the undecodable bytes left out."""
    return F.replace(F.make_valid_utf8(_col(column).cast("string")), F.lit("�"), F.lit(""))


def fill_blank_symbol(df: DataFrame, symbol: str | Column, column: str = "symbol") -> DataFrame:
    """Take the symbol from the context of the request where a row has none."""
    given = symbol if isinstance(symbol, Column) else F.lit(symbol)
    own = clean_symbol(column) if column in df.columns else F.lit(None).cast("string")
    return df.withColumn(column, F.coalesce(own, F.upper(F.trim(given))))


def filter_listing(df: DataFrame, exchange: str = "HOSE", kind: str = "STOCK") -> DataFrame:
    """Instruments of one exchange and type; letter case is ignored."""
    require_columns(df, ["exchange", "type"], "listing")
    return df.where(
        (F.upper(F.col("exchange").cast("string")) == exchange.upper())
        & (F.upper(F.col("type").cast("string")) == kind.upper())
    )


def filter_min_date(df: DataFrame, column: str, min_date: str) -> DataFrame:
    """Rows on or after a date; unreadable dates are dropped, an absent column filters nothing."""
    if column not in df.columns:
        return df
    return df.where(to_date_any(column, df.schema[column].dataType) >= F.lit(min_date).cast("date"))


def with_ingested_at(df: DataFrame, name: str = "ingested_at") -> DataFrame:
    return df.withColumn(name, F.current_timestamp())


def drop_audit_columns(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c == "ingested_at" or c.startswith("ingested_at_")])


def conform(
    df: DataFrame,
    columns: Sequence[str],
    renames: dict[str, str] | None = None,
    not_null: Sequence[str] = (),
) -> DataFrame:
    """Check, rename and order the columns of a stage table and drop rows with a null key."""
    renames = renames or {}
    back = {new: old for old, new in renames.items()}
    require_columns(df, [back.get(c, c) for c in columns], "stage table")
    out = df.withColumnsRenamed(renames).select(*columns)
    for key in not_null:
        out = out.where(F.col(key).isNotNull())
    return out


def date_key(column: str | Column) -> Column:
    """yyyymmdd as an integer."""
    c = _col(column)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def is_weekend(column: str | Column) -> Column:
    return F.weekday(_col(column)) >= 5


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key: the first in the given order, further ties broken by the other columns.

    Spark limits each key to one row per map task before the shuffle, so copies of a key do not meet.
    """
    named = [_col(c) for c in order]
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    if not named and not rest:
        return df.distinct()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*named, *rest))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def one_per_key(df: DataFrame, keys: Sequence[str], newest: str | None = None) -> DataFrame:
    """One row per key, combined before the shuffle: the last by ``newest`` where there is such a column, then by the other columns."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = [newest, *[c for c in rest if c != newest]] if newest in rest else rest
    # max() of a struct compares field by field, nulls first.
    best = df.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(*keys, *[F.col(f"_best.{c}").alias(c) for c in rest]).select(*df.columns)


def normalise_summary(df: DataFrame) -> DataFrame:
    """The raw fundamentals in their fixed column set, text and byte values read as numbers."""
    def text_of(name: str) -> Column:
        return decode_utf8(name) if isinstance(df.schema[name].dataType, BinaryType) else F.col(name)

    def column(name: str) -> Column:
        if name not in df.columns:
            if name == "symbol" or name == "date":
                return F.lit(None).cast("string")
            return F.lit(None).cast("string" if name == "ingested_at" else "double")
        if name == "symbol":
            return F.upper(F.trim(text_of(name).cast("string")))
        if name == "date":
            return F.date_format(to_date_any(name, df.schema[name].dataType), "yyyy-MM-dd")
        if name in RAW_SUMMARY_METRICS:
            return to_double(text_of(name))
        return F.col(name)

    return df.select(*[column(c).alias(c) for c in RAW_SUMMARY_COLUMNS])


def index_members(df: DataFrame, index_symbol: str) -> DataFrame:
    """A vendor's member list as (index_symbol, symbol, ...), one row per symbol."""
    require_columns(df, ["symbol"], f"member list of {index_symbol}")
    rest = [c for c in df.columns if c not in ("symbol", "index_symbol")]
    out = df.select(
        F.lit(index_symbol).alias("index_symbol"), clean_symbol("symbol").alias("symbol"), *rest
    ).where(F.col("symbol").isNotNull())
    return keep_first(out, ["index_symbol", "symbol"], [])


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column
