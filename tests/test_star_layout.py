"""Star facts go into their months without a shuffle: the tables that they are made from lie in ranges of symbols."""

import re
from datetime import date, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from candlewright.operators.indicators import daily_indicators
from candlewright.operators.lookups import join_summary
from candlewright.plans import flows, serving
from workbench.stage import Stage, StagedStar

BARS = "symbol string, trade_date date, open double, high double, low double, close double, volume bigint"
SUMMARY = "symbol string, trade_date date, eps double, market_cap double, pe double, pb double, roe double, dividend_yield double, high_52w double, low_52w double"
SYMBOLS = [f"S{i:02d}" for i in range(40)]


def day(i):
    return date(2020, 1, 1) + timedelta(days=i)


def tables(spark):
    prices = {(s, i): 10.0 + (7 * k + 3 * i) % 23 for k, s in enumerate(SYMBOLS) for i in range(70)}
    bars = [(s, day(i), p, p + 1, p - 1, p, 5) for (s, i), p in prices.items()] + [(None, day(0), 1.0, 2.0, 0.5, 1.0, 7)]
    figures = [(s, day(i), 2.0, 100 * p, p / 2, p / 9, 12.0, 3.0, 40.0, 5.0) for (s, i), p in prices.items() if i % 3]
    return spark.createDataFrame(bars, BARS), spark.createDataFrame(figures, SUMMARY)


def rows_of(df):
    df = df.select(*sorted(c for c in df.columns if c != "trade_month"))
    return sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


@pytest.fixture
def made(spark, monkeypatch):
    """A stage over small tables, and the columns that frames were laid out by in ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    bars, summary = tables(spark)
    stage = Stage(spark, uuid4().hex)
    stocks = spark.createDataFrame([(i + 1, s, ("Banks", "Food")[i % 2]) for i, s in enumerate(SYMBOLS)], "stock_key int, symbol string, sector string")
    vars(stage).update(bars=bars.where("symbol IS NOT NULL"), summary=summary, dim_stock=stocks)
    laid, real = [], type(bars).repartitionByRange
    monkeypatch.setattr(type(bars), "repartitionByRange", lambda self, *columns: laid.append(columns) or real(self, *columns))
    yield stage, laid
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranges_of_symbols_serve_the_windows(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        bars, summary = tables(spark)
        for figures in (summary, summary.select("symbol", "trade_date")):
            text = daily_indicators(join_summary(bars, figures, ranged=True))._jdf.queryExecution().executedPlan().toString()
            assert re.findall(r"Exchange (\w+partitioning)", text) == ["rangepartitioning"]
        for figures in (summary, None):
            assert rows_of(flows.equity_indicators(bars, figures, ranged=True)) == rows_of(flows.equity_indicators(bars, figures))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def spans(df, column):
    found = df.groupBy(F.input_file_name().alias("f")).agg(F.min(column).alias("a"), F.max(column).alias("b")).collect()
    return sorted((r["a"], r["b"]) for r in found)


def test_star_facts_are_not_shuffled_into_months(spark, made):
    stage, laid = made
    facts, labels = stage.fact_equity, stage.fact_signals
    assert laid and not [c for c in laid if c[0] == "trade_month"]
    key = F.col("stock_key").cast("int")
    named = stage.dim_stock.select("stock_key", "symbol")
    want = flows.equity_indicators(stage.bars, stage.summary).join(named, "symbol")
    assert rows_of(facts.select(key.alias("k"), "date_key", "rsi_14", "sma_50", "pe")) == rows_of(want.select(F.col("stock_key").alias("k"), F.date_format("trade_date", "yyyyMMdd").cast("int").alias("date_key"), "rsi_14", "sma_50", "pe"))
    assert labels.count() == facts.count() == 70 * len(SYMBOLS)
    assert {f.split("trade_month=")[1][:7] for f in facts.inputFiles()} == {"2020-01", "2020-02", "2020-03"}
    for table, column in ((stage.equity, "symbol"), (stage.signals, "symbol")):
        ranges = spans(table, column)
        assert len(ranges) > 1 and all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_a_screener_asks_for_its_signals_first(spark):
    class Tables:
        built = []

        def __getattr__(self, name):
            self.built.append(name)
            return {
                "dates": spark.createDataFrame([(20240101, date(2024, 1, 1))], "date_key int, trade_date date"),
                "facts": spark.createDataFrame([(1, 20240101, 5.0)], "stock_key int, date_key int, close double"),
                "labels": spark.createDataFrame([(1, 20240101, "x", "y")], "stock_key int, date_key int, label_stock_class string, label_trading_action string"),
                "stocks": spark.createDataFrame([(1, "A", "a", "s", "e")], "stock_key int, symbol string, organ_short_name string, sector string, exchange string"),
            }[name]

    star = StagedStar(Tables(), dim_stock="stocks", dim_date="dates", equity="facts", stock_signals="labels")
    assert serving.screener_total(star, signal="Y").first()[0] == 1
    assert Tables.built.index("labels") < Tables.built.index("facts")
