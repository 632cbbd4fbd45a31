"""Sector by day aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewright.operators.lookups import lookup_join


def with_sector(equity: DataFrame, dim_stock: DataFrame, dim_sector: DataFrame) -> DataFrame:
    """Facts of stocks that have a non-blank sector known to the sector dimension."""
    stocks = dim_stock.select("stock_key", "sector").where(F.col("sector").isNotNull() & (F.col("sector") != ""))
    sectors = dim_sector.select("sector_key", "sector")
    return lookup_join(lookup_join(equity, stocks, ["stock_key"], "inner"), sectors, ["sector"], "inner")


def sector_daily(equity: DataFrame, dim_stock: DataFrame, dim_sector: DataFrame) -> DataFrame:
    """Cap-weighted change, traded value, cap, harmonic ratios, mean earnings and stock count.

    A missing change counts as 0 while its cap stays in the weight; ratios use positive values only;
    an empty denominator gives null.
    """
    cap = F.coalesce(F.col("market_cap"), F.lit(0.0))
    change = F.coalesce(F.col("price_change_pct"), F.lit(0.0))
    traded = F.coalesce(F.col("close"), F.lit(0.0)) * F.coalesce(F.col("total_volume"), F.lit(0))

    def harmonic(ratio: str):
        valid = F.col(ratio) > 0
        return F.try_divide(F.sum(F.when(valid, cap)), F.sum(F.when(valid, cap / F.col(ratio))))

    rows = with_sector(equity, dim_stock, dim_sector)
    sums = rows.groupBy("sector_key", "date_key").agg(
        F.try_divide(F.sum(change * cap), F.sum(cap)).alias("price_change_pct"),
        F.sum(traded).alias("total_trade_value"),
        F.sum(cap).alias("total_market_cap"),
        harmonic("pe").alias("avg_pe"),
        harmonic("pb").alias("avg_pb"),
        F.avg("eps").alias("avg_eps"),
    )
    # Counted apart: beside a distinct count Spark would shuffle all sums of every stock and day.
    stocks = rows.select("sector_key", "date_key", "stock_key").distinct().groupBy(
        F.col("sector_key").alias("_sector"), F.col("date_key").alias("_date")).agg(F.count("stock_key").cast("int").alias("stock_count"))
    same = F.col("sector_key").eqNullSafe(F.col("_sector")) & F.col("date_key").eqNullSafe(F.col("_date"))
    return sums.join(stocks, same).drop("_sector", "_date")


def breadth(sectors: DataFrame) -> DataFrame:
    """Sectors up and down per day."""
    return sectors.groupBy("date_key").agg(
        F.count_if(F.col("price_change_pct") > 0).alias("sectors_up"),
        F.count_if(F.col("price_change_pct") < 0).alias("sectors_down"),
    )
