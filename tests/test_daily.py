"""Daily jobs that go on from stored state, against rebuilding everything."""

import math
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from candlewright.functions.cleanse import date_key
from candlewright.operators import carry
from candlewright.operators.indicators import daily_indicators
from candlewright.plans import daily, serving
from candlewright.sources import files
from candlewright.sources.writers import Store

FIRST = date(2023, 11, 20)
SCHEMA = "symbol string, time timestamp_ntz, open double, high double, low double, close double, volume bigint"


def prints(spark, days, symbols=("AAA", "BBB", "CCC"), seed=1):
    """One print per symbol and weekday; CCC is silent for months, BBB has gaps, DDD begins late."""
    rng, rows = random.Random(seed), []
    price = dict.fromkeys(symbols, 50.0)
    for i in range(days):
        day = FIRST + timedelta(days=i)
        for s in symbols:
            price[s] = max(1.0, price[s] + rng.uniform(-2, 2))
            silent = s == "CCC" and 15 < i < 120 or s == "BBB" and i % 5 == 2 or s == "DDD" and i < 100
            if day.weekday() < 5 and not silent:
                rows.append((s, f"{day} 10:00:00", price[s], price[s] + 1, price[s] - 1, price[s], 10 + i % 7))
    return spark.createDataFrame(rows, SCHEMA.replace("time timestamp_ntz", "time string")).withColumn("time", F.col("time").cast("timestamp_ntz"))


def figures(spark, of):
    """Fundamentals of some of the days."""
    return of.select("symbol", F.date_format("time", "yyyy-MM-dd").alias("date"), (F.col("close") / 3).alias("eps"), (F.col("close") / 7).alias("pe"), (F.col("close") * 100).alias("market_cap")).where(F.dayofmonth(F.col("time")) % 3 != 0)


def store(spark, root):
    s = Store(spark, str(root))
    s.publish(spark.createDataFrame([(1, "AAA", "Banks"), (2, "BBB", "Banks"), (3, "CCC", None), (4, "DDD", "Food")], "stock_key int, symbol string, sector string"), "master.dim_stock", checks=[])
    s.publish(spark.createDataFrame([(1, "Banks"), (2, "Food")], "sector_key int, sector string"), "master.dim_sector", checks=[])
    s.publish(spark.createDataFrame([(1, "AAA"), (2, "BBB"), (3, "CCC")], "index_key bigint, index_symbol string"), "master.dim_index", checks=[])
    return s


def rows_of(df):
    df = df.select(*sorted(df.columns))
    return sorted((tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def same(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b):
        assert all(p == q or isinstance(p, float) and isinstance(q, float) and math.isclose(p, q, rel_tol=1e-6, abs_tol=1e-6) for p, q in zip(x, y)), (x, y)


TABLES = ["stage_2.fact_market_equity", "stage_2.fact_stock_signals", "master.fact_market_equity", "master.fact_stock_signals", "master.fact_market_sector"]


def between(df, low, high, column="time"):
    return df.where((F.to_date(column) >= F.lit(FIRST + timedelta(days=low))) & (F.to_date(column) < F.lit(FIRST + timedelta(days=high))))


@pytest.mark.parametrize("cut", [1, 37, 130])
def test_going_on_equals_starting_over(spark, cut):
    bars = prints(spark, 200, ("AAA", "BBB", "CCC", "DDD")).select("symbol", F.to_date("time").alias("trade_date"), "open", "high", "low", "close", "volume")
    bars = bars.withColumn("close", F.when((F.col("symbol") != "BBB") | (F.dayofmonth("trade_date") != 9), F.col("close")))
    month = (FIRST + timedelta(days=cut)).strftime("%Y-%m")
    before = carry.continued_indicators(bars.where(carry.month_of("trade_date") <= month))
    state = carry.states(before, None, [month]).where(F.col("state_month") == month).drop("state_month")
    assert state.schema.simpleString() == spark.createDataFrame([], carry.STATE).schema.simpleString()
    assert max(len(r["tail"]) for r in state.collect()) <= carry.TAIL
    rest = bars.where(carry.month_of("trade_date") > month)
    after = carry.continued_indicators(rest, state)
    columns = ["symbol", "trade_date", "ema_12", "ema_26", "macd", "rsi_14", "sma_20", "sma_50", "price_change_pct", "vwap", "total_volume"]
    want = daily_indicators(bars).where(carry.month_of("trade_date") > month)
    same(rows_of(after.select(*columns)), rows_of(want.select(*columns)))


def test_day_by_day_equals_a_rebuild(spark, tmp_path):
    everything = prints(spark, 130, ("AAA", "BBB", "CCC", "DDD"))
    summary = figures(spark, everything)
    grown, whole = store(spark, tmp_path / "grown"), store(spark, tmp_path / "whole")
    spans = [(0, 77), (77, 78), (78, 81), (81, 108), (108, 130)]
    for low, high in spans:
        daily.equity_daily(grown, between(everything, low, high), between(summary, low, high, "date"))
    # Days sent again, with other values first, then the true ones: back to the state before their month.
    wrong = between(everything, 60, 64).withColumn("close", F.col("close") * 2)
    daily.equity_daily(grown, wrong)
    daily.equity_backfill(grown, everything, summary, FIRST + timedelta(days=64), 4)
    daily.equity_daily(whole, everything, summary)
    for name in TABLES:
        same(rows_of(grown.read(name)), rows_of(whole.read(name)))
    assert grown.marks("stage_2.fact_market_equity") == []


def test_a_daily_run_reads_its_month_only(spark, tmp_path, monkeypatch):
    everything = prints(spark, 130)
    grown = store(spark, tmp_path)
    daily.equity_daily(grown, between(everything, 0, 120))
    seen = []
    real = carry.continued_indicators

    def watched(bars, state=None, include_vwap=True):
        seen.append((bars.agg(F.min("trade_date")).first()[0], None if state is None else state.agg(F.max("trade_date"), F.max(F.size("tail"))).first()))
        return real(bars, state, include_vwap)

    monkeypatch.setattr(daily.flows, "continued_indicators", watched)
    daily.equity_daily(grown, between(everything, 120, 121))
    (oldest, (last, longest)), = seen
    today = FIRST + timedelta(days=120)
    assert oldest >= today.replace(day=1) and last < today.replace(day=1) and longest <= 50


def test_a_broken_run_is_done_again(spark, tmp_path, monkeypatch):
    everything = prints(spark, 130)
    grown, whole = store(spark, tmp_path / "grown"), store(spark, tmp_path / "whole")
    daily.equity_daily(grown, between(everything, 0, 100))
    real = daily.sector_daily

    def failing(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(daily, "sector_daily", failing)
    with pytest.raises(RuntimeError):
        daily.equity_daily(grown, between(everything, 100, 104))
    monkeypatch.setattr(daily, "sector_daily", real)
    daily.equity_daily(grown, between(everything, 125, 130))
    daily.equity_daily(grown, between(everything, 104, 125))
    daily.equity_daily(whole, everything)
    for name in TABLES:
        same(rows_of(grown.read(name)), rows_of(whole.read(name)))


def test_index_day_by_day(spark, tmp_path):
    everything = prints(spark, 90)
    grown, whole = store(spark, tmp_path / "grown"), store(spark, tmp_path / "whole")
    for low, high in ((0, 50), (50, 51), (51, 90)):
        daily.index_daily(grown, between(everything, low, high))
    daily.index_daily(whole, everything)
    for name in ("master.fact_market_index", "master.fact_index_signals"):
        same(rows_of(grown.read(name)), rows_of(whole.read(name)))


def test_lost_swaps_are_undone(spark, tmp_path):
    s = Store(spark, str(tmp_path))
    df = spark.createDataFrame([(1, "2024-01"), (2, "2024-02")], "v int, m string")
    s.publish_parts(df, "t", "m", ["v"], checks=[])
    table = tmp_path / "t"
    (table / "m=2024-01").rename(table / ".replaced-m=2024-01")
    assert rows_of(s.read("t")) == rows_of(df)
    table.rename(tmp_path / "t__replaced")
    assert s.has("t") and rows_of(s.read("t")) == rows_of(df)
    s.publish_parts(spark.createDataFrame([(9, "2024-02"), (7, "2024-03")], "v int, m string"), "t", "m", ["v"], checks=[])
    assert rows_of(s.read("t").select("m", "v")) == [("2024-01", 1), ("2024-02", 9), ("2024-03", 7)]
    assert files.partition_values(spark, str(table), "m") == ["2024-01", "2024-02", "2024-03"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_served_queries_read_few_months(spark, tmp_path):
    grown = store(spark, tmp_path)
    everything = prints(spark, 130)
    out = daily.equity_daily(grown, everything, figures(spark, everything))
    days = everything.select(F.to_date("time").alias("trade_date")).distinct()
    last = days.agg(F.max("trade_date")).first()[0]
    known = days.where(F.col("trade_date") < F.lit(last)).select(date_key("trade_date").alias("date_key"), "trade_date")
    star = serving.Star(dim_stock=grown.read("master.dim_stock"), dim_date=known, equity=out["equity"], stock_signals=out["signals"], dim_sector=grown.read("master.dim_sector"), sector=out["sector"])
    flat = serving.Star(dim_stock=star.dim_stock, dim_date=known, equity=star.equity.drop("trade_month"), stock_signals=star.stock_signals.drop("trade_month"), dim_sector=star.dim_sector, sector=star.sector.drop("trade_month"))
    asked = {
        "movers": serving.top_movers, "sectors": serving.top_sectors, "latest": serving.sectors_latest,
        "history": lambda s: serving.stock_history(s, "BBB", limit=10), "span": lambda s: serving.stock_history(s, "AAA", "2024-01-05", "2024-02-03", 90),
        "long": lambda s: serving.stock_history(s, "CCC", limit=20), "signals": lambda s: serving.signal_history(s, "AAA", 5),
        "sector": lambda s: serving.sector_history(s, 1, limit=7), "detail": lambda s: serving.sector_detail(s, 1), "stocks": lambda s: serving.sector_top_stocks(s, 1),
    }
    for name, query in asked.items():
        got, want = query(star), query(flat)
        assert rows_of(got) == rows_of(want) and got.count() > 0, name
        assert "PartitionFilters: [isnotnull(trade_month" in plan(got), name
    screen = rows_of(serving.screener(star, sort_by="pe", limit=5))
    assert screen == rows_of(serving.screener(flat, sort_by="pe", limit=5))
    # The newest month of the fact is asked first: one folder of each table.
    import re
    assert set(re.findall(r"trade_month[#0-9]* = (2024-[0-9]+)", plan(serving.top_movers(star)))) == {known.agg(F.max("trade_date")).first()[0].strftime("%Y-%m")}
