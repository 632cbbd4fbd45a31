"""The given tables seen as market data.

supplier is the instrument list (nation its sector, region its exchange and index), lineitem the
intraday prints, orders the calendar and the company events, events the candle stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F

from candlewright.operators.bars import daily_bars
from candlewright.operators.lookups import lookup_join
from candlewright.plans.flows import clean_summary

MEMBER_INDEX_STEP = 5


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def instruments(spark: SparkSession, d: str) -> DataFrame:
    """symbol, sid, sector_id, sector, exchange, type and names of each instrument."""
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.upper("s_name").alias("symbol"), F.col("s_suppkey").alias("sid"),
        F.col("n_nationkey").alias("sector_id"), F.col("n_name").alias("sector"),
        F.col("r_regionkey").cast("bigint").alias("index_id"), F.col("r_name").alias("exchange"),
        F.when(F.col("s_suppkey") % 7 == 0, "FUND").otherwise("STOCK").alias("type"),
        F.concat(F.lit("Company "), F.col("s_suppkey").cast("string")).alias("name"),
        F.concat(F.lit("Co "), F.col("s_name").substr(-4, 4)).alias("organ_short_name"),
    )


def print_order() -> Column:
    """Total order of the prints of one instrument and day as one fixed-width number."""
    line = F.col("l_orderkey").cast("decimal(20,0)") * 8 + F.col("l_linenumber")
    return (line * F.lit(10**12).cast("decimal(13,0)") + F.col("l_partkey")).cast("decimal(38,0)")


def prints(spark: SparkSession, d: str) -> DataFrame:
    """Prints by instrument id: every line is one trade at its unit price."""
    price = F.col("l_extendedprice") / F.col("l_quantity")
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.col("l_shipdate").alias("time"),
        *[price.alias(c) for c in ("open", "high", "low", "close")],
        F.col("l_quantity").cast("bigint").alias("volume"), print_order().alias("seq"),
    )


def named(df: DataFrame, spark: SparkSession, d: str) -> DataFrame:
    """Replace the instrument id by its symbol, after the data has been reduced."""
    names = table(spark, d, "supplier").select(F.col("s_suppkey").alias("_id"), F.upper("s_name").alias("symbol"))
    rest = [c for c in df.columns if c != "symbol"]
    return lookup_join(df.withColumnRenamed("symbol", "_id"), names, ["_id"], "inner").select("symbol", *rest)


def bars(spark: SparkSession, d: str) -> DataFrame:
    return named(daily_bars(prints(spark, d), "seq"), spark, d)


def index_prints(spark: SparkSession, d: str) -> tuple[DataFrame, str]:
    """Prints of one index per region, and the column that orders them."""
    home = instruments(spark, d).select(F.col("sid").alias("symbol"), F.col("exchange").alias("_index"))
    rows = lookup_join(prints(spark, d), home, ["symbol"], "inner")
    ordered = (F.col("seq") * 1000 + F.pmod(F.col("symbol"), F.lit(1000))).cast("decimal(38,0)")
    return rows.withColumn("seq", ordered).drop("symbol").withColumnRenamed("_index", "symbol"), "seq"


def index_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars of one index per region over the prints of all its instruments."""
    return daily_bars(*index_prints(spark, d))


def before_extremes(df: DataFrame, by: WindowSpec, rows: int, highest: dict[str, str], lowest: dict[str, str]) -> DataFrame:
    """Columns of the highest and lowest values of the last ``rows`` rows before each row.

    The extremes of 8, 64 and so on rows come from eight of an eighth: a few lags a row instead of a frame of ``rows`` rows.
    """
    fold = {k: (c, F.greatest) for k, c in highest.items()} | {k: (c, F.least) for k, c in lowest.items()}
    span, out = 1, df.withColumns({k: F.col(c) for k, (c, _) in fold.items()})
    while 8 * span <= rows:
        out = out.withColumns({k: pick(F.col(k), *[F.lag(k, span * i).over(by) for i in range(1, 8)]) for k, (_, pick) in fold.items()})
        span *= 8
    at = [*range(1, 1 + rows - span, span), 1 + rows - span]
    # The value itself is no part of the answer; a null beside it lets one lag pass through.
    return out.withColumns({k: pick(F.lit(None).cast(df.schema[c].dataType), *[F.lag(k, i).over(by) for i in at]) for k, (c, pick) in fold.items()})


def raw_summary(spark: SparkSession, d: str) -> DataFrame:
    """Fundamentals per instrument and day, missing on every fourth day of the month (1, 5, 9 and so on).

    The lines are shuffled once, by instrument, for the figures of a day and the extremes along the days alike. An instrument
    trades a line or two a day: sums made before the shuffle would be wider than the lines and not fewer.
    """
    price = F.col("l_extendedprice") / F.col("l_quantity")
    lines = table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("trade_date"), "l_extendedprice", "l_quantity", "l_tax", "l_discount")
    figures = lines.repartition("symbol").groupBy("symbol", "trade_date").agg(
        F.max(price).alias("_high"), F.min(price).alias("_low"), F.avg(price).alias("_price"),
        F.sum("l_extendedprice").alias("market_cap"), (10000 * F.avg("l_tax")).alias("eps"),
        (250 * F.avg("l_discount")).alias("roe"), (125 * F.avg("l_tax")).alias("dividend_yield"),
    )
    ranged = before_extremes(figures, Window.partitionBy("symbol").orderBy("trade_date"), 252, {"high_52w": "_high"}, {"low_52w": "_low"})
    kept = ranged.where(F.dayofmonth("trade_date") % 4 != 1)
    return named(kept, spark, d).select(
        "symbol", F.col("trade_date").cast("string").alias("date"), "high_52w", "low_52w", "eps",
        "market_cap", F.try_divide("_price", "eps").alias("pe"), (F.col("_price") / 2000).alias("pb"),
        "roe", "dividend_yield",
    )


def summary(spark: SparkSession, d: str) -> DataFrame:
    return clean_summary(raw_summary(spark, d))


def candles(spark: SparkSession, d: str) -> DataFrame:
    """One candle per event; ``received_at`` trails by a varying latency."""
    price = 50.0 + F.get_json_object("props", "$.k").cast("double")
    wait = F.make_dt_interval(secs=(F.col("event_id") * 37 % 4000 / 1000).cast("decimal(18,6)"))
    return table(spark, d, "events").select(
        F.col("event_id"), F.col("event_type").alias("symbol"), F.col("ts").alias("candle_time"),
        (F.col("ts") + wait).alias("received_at"),
        price.alias("open"), (price + F.col("event_id") % 3).alias("high"), (price - F.col("event_id") % 2).alias("low"),
        price.alias("close"), F.round(F.col("value") * 10).cast("bigint").alias("volume"),
    )


def revised_candles(spark: SparkSession, d: str) -> DataFrame:
    """Candles of which every seventh is sent again a second later at another price."""
    first = candles(spark, d)
    later = first.where(F.col("event_id") % 7 == 0).withColumns({
        "received_at": F.col("received_at") + F.expr("interval 1 second"),
        "high": F.col("high") + 3, "close": F.col("close") + 2, "volume": F.col("volume") + 5,
    })
    return first.unionByName(later)


def calendar(spark: SparkSession, d: str) -> DataFrame:
    """Distinct order days with calendar attributes."""
    day = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    c = F.col("date")
    return day.select(
        c, F.quarter(c).alias("cal_quarter"), F.month(c).alias("cal_month"), F.weekofyear(c).alias("week"),
        F.dayofweek(c).alias("day_of_week"),
    )


def market_events(spark: SparkSession, d: str) -> DataFrame:
    """Urgent days; high-priority days carry a blank type and are no holidays."""
    kind = F.col("o_orderpriority")
    return table(spark, d, "orders").where(kind.isin("1-URGENT", "2-HIGH")).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), kind.alias("event_name"),
        F.when(kind == "1-URGENT", "holiday").otherwise(" ").alias("event_type"), F.lit(1).alias("duration"),
    ).distinct()


def raw_company_events(spark: SparkSession, d: str) -> DataFrame:
    owner = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("ticker"))
    rows = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    return lookup_join(rows, owner, ["c_custkey"], "inner").select(
        F.concat(F.lit(" "), F.lower("ticker"), F.lit(" ")).alias("ticker"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("public_date"),
        F.col("o_orderpriority").alias("event_name_vi"),
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("event_title_vi"),
        F.col("o_orderstatus").alias("event_code"),
    )


def raw_company_news(spark: SparkSession, d: str) -> DataFrame:
    owner = table(spark, d, "customer").select("c_custkey", F.col("c_name").alias("symbol"))
    rows = table(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    key = F.col("o_orderkey").cast("string")
    return lookup_join(rows, owner, ["c_custkey"], "inner").select(
        "symbol", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("public_date"),
        F.concat(F.lit("News "), key).alias("news_title"), F.col("o_orderpriority").alias("news_short_content"),
        F.lit(None).cast("string").alias("news_image_url"), F.concat(F.lit("src/"), key).alias("news_source_link"),
    )


def customers_as_stocks(spark: SparkSession, d: str) -> DataFrame:
    """A stock dimension over customers, for company events and news."""
    return table(spark, d, "customer").where(F.col("c_custkey") % 10 != 3).select(
        (F.col("c_custkey") + 1).cast("int").alias("stock_key"), F.upper("c_name").alias("symbol")
    )


def memberships(spark: SparkSession, d: str, skip: int) -> DataFrame:
    return table(spark, d, "customer").where(F.col("c_custkey") % skip != 0).select(
        F.col("c_name").alias("symbol"), F.col("c_nationkey").cast("bigint").alias("index_id")
    )


def index_info(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "region").select(
        F.col("r_regionkey").cast("string").alias("index_id"), F.concat(F.lit(" "), F.lower("r_name")).alias("symbol"),
        F.col("r_name").alias("name"), F.lit("index of a region").alias("description"), F.lit("region").alias("group"),
    )


def sector_info(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "nation").select(
        F.col("n_nationkey").cast("string").alias("sector_id"), F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("sector"),
        F.current_timestamp().alias("ingested_at"),
    )
