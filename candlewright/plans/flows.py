"""Daily jobs: compositions of the operators with a quality gate before every published table."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions import labels as L
from candlewright.functions.cleanse import clean_symbol, metric_columns, one_per_key, require_columns, with_date
from candlewright.operators.carry import continued_indicators
from candlewright.operators.indicators import daily_indicators
from candlewright.operators.lookups import join_summary, lookup_join
from candlewright.operators.quantiles import exact_quantiles
from candlewright.schemas import (
    EQUITY_COLUMNS,
    INDEX_COLUMNS,
    INDEX_SIGNAL_COLUMNS,
    STOCK_SIGNAL_COLUMNS,
    SUMMARY_METRICS,
)
from candlewright.session import pinned

FEW_MEDIANS = 200_000


def clean_summary(raw: DataFrame) -> DataFrame:
    """Fundamentals per (symbol, trade_date): typed, trimmed, one row per key, the one ingested last."""
    require_columns(raw, ["symbol", "date"], "summary table")
    typed = with_date(raw, "date", "trade_date").select(
        clean_symbol("symbol").alias("symbol"), "trade_date", *metric_columns(raw, SUMMARY_METRICS),
        *([F.col("ingested_at").cast("string").alias("ingested_at")] if "ingested_at" in raw.columns else []),
    )
    named = typed.where(F.col("symbol").isNotNull() & F.col("trade_date").isNotNull())
    return one_per_key(named, ["symbol", "trade_date"], "ingested_at").drop("ingested_at")


def equity_indicators(bars: DataFrame, summary: DataFrame | None = None, ranged: bool = False) -> DataFrame:
    """Bars with indicators and, where there are any, fundamentals; ``ranged``: see ``join_summary``."""
    if summary is None:
        empty = {m: F.lit(None).cast("double") for m in SUMMARY_METRICS}
        return daily_indicators(bars.repartitionByRange("symbol") if ranged else bars).withColumns(empty).select(*EQUITY_COLUMNS)
    # Joined first: the windows then leave the frame partitioned by symbol for the labels.
    return daily_indicators(join_summary(bars, summary, ranged)).select(*EQUITY_COLUMNS)


def continued_equity(bars: DataFrame, summary: DataFrame | None, state: DataFrame | None) -> DataFrame:
    """``equity_indicators`` that goes on from a state, with the averages behind it and macd_prev."""
    if summary is None:
        return continued_indicators(bars, state).withColumns({m: F.lit(None).cast("double") for m in SUMMARY_METRICS})
    return continued_indicators(join_summary(bars, summary), state)


def index_indicators(bars: DataFrame) -> DataFrame:
    return daily_indicators(bars, include_vwap=False).select(*INDEX_COLUMNS)


def with_sector_median(equity: DataFrame, dim_stock: DataFrame, value: str = "pe") -> DataFrame:
    """Add the sector of each stock and the median of ``value`` per (sector, day).

    Stocks without a sector form a group of their own.
    """
    if "sector" not in dim_stock.columns:
        return equity.withColumns({"sector": F.lit(None).cast("string"), "pe_median_sector": F.lit(None).cast("double")})
    sectors = dim_stock.where(F.col("sector").isNotNull() & (F.col("sector") != "")).groupBy("symbol").agg(
        F.min("sector").alias("sector")
    )
    # "" stands for the group without a sector, so that the join back stays an equi-join.
    known = lookup_join(equity, sectors, ["symbol"], "left").withColumn("_group", F.coalesce("sector", F.lit("")))
    medians = pinned(exact_quantiles(known, ["_group", "trade_date"], value, [0.5], ["pe_median_sector"]))
    # One row per sector and day: where these are few the facts stay where they lie. Else a hot one is split by the adaptive skew join.
    if medians.limit(FEW_MEDIANS + 1).count() <= FEW_MEDIANS:
        medians = F.broadcast(medians)
    return known.join(medians, ["_group", "trade_date"], "left").drop("_group")


def with_previous_macd(equity: DataFrame) -> DataFrame:
    """Add macd_prev; one row per (symbol, trade_date), so a symbol is bounded by the calendar."""
    by_day = Window.partitionBy("symbol").orderBy("trade_date")
    return equity.withColumn("macd_prev", F.lag("macd").over(by_day))


def label_stocks(equity: DataFrame) -> DataFrame:
    """All stock labels, from rows that carry macd_prev and pe_median_sector."""
    c = F.col
    single = equity.withColumns({
        "signal_rsi": L.rsi_label(c("rsi_14")),
        "signal_trend": L.trend_label(c("close"), c("sma_20"), c("sma_50")),
        "signal_macd": L.macd_label(c("macd"), c("macd_prev")),
        "signal_dividend": L.dividend_label(c("dividend_yield")),
        "signal_roe": L.roe_label(c("roe")),
        "signal_pe": L.pe_label(c("pe"), c("pe_median_sector")),
        "signal_pb": L.pb_label(c("pb")),
        "signal_price_pos": L.price_position_label(c("close"), c("high_52w"), c("low_52w")),
    })
    return single.withColumns({
        "label_stock_class": L.stock_class_label(c("signal_roe"), c("signal_pe")),
        "label_trading_action": L.trading_action_label(c("rsi_14"), c("signal_macd"), c("close"), c("sma_20")),
    })


def stock_signals(equity: DataFrame, dim_stock: DataFrame) -> DataFrame:
    return signals_of(with_previous_macd(equity), dim_stock)


def signals_of(rows: DataFrame, dim_stock: DataFrame) -> DataFrame:
    """As ``stock_signals``, of rows that carry macd_prev already."""
    return label_stocks(with_sector_median(rows, dim_stock)).select("symbol", "trade_date", *STOCK_SIGNAL_COLUMNS)


def index_signals(index: DataFrame) -> DataFrame:
    c = F.col
    return index.select(
        "symbol", "trade_date",
        L.trend_label(c("close"), c("sma_20"), c("sma_50")).alias("signal_market_trend"),
        L.rsi_label(c("rsi_14")).alias("signal_market_rsi"),
    )


def label_distribution(signals: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(signal, label, n) for every label column, in one pass over the signals."""
    names = columns or [c for c in signals.columns if c.startswith(("signal_", "label_"))]
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("signal"), F.col(n).alias("label")) for n in names]))
    return signals.select(pairs.alias("_p")).select("_p.*").groupBy("signal", "label").agg(
        F.count(F.lit(1)).alias("n")
    )
