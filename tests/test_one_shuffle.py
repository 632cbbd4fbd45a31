"""Daily facts are shuffled once by symbol, and a query builds only the tables that it reads."""

import random
import re
from datetime import date, timedelta

import pytest

from candlewright.operators.indicators import SPAN_12, WILDER, daily_indicators
from candlewright.operators.lookups import join_summary
from candlewright.operators.sector import sector_daily
from candlewright.operators.series import ema_columns, ema_columns_bounded, positions
from candlewright.plans import flows, serving
from workbench.stage import StagedStar

BARS = "symbol string, trade_date date, open double, high double, low double, close double, volume bigint"


@pytest.fixture
def plain(spark):
    """No broadcast and no adaptive plans: every exchange shows."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k in settings:
        spark.conf.unset(k)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def day(i):
    return date(2020, 1, 1) + timedelta(days=i)


def test_indicators_with_fundamentals_take_one_shuffle(plain):
    bars = plain.createDataFrame([(s, day(i), 1.0, 2.0, 0.5, 1.0 + i, 7) for s in "AB" for i in range(5)] + [(None, day(0), 1.0, 2.0, 0.5, 1.0, 7)], BARS)
    summary = plain.createDataFrame(
        [("A", day(1), "1", 5.0), ("A", day(1), "2", 4.0), ("A", day(9), "1", 3.0), (None, day(0), "1", 9.0), ("B", day(0), "1", None)],
        "symbol string, trade_date date, ingested_at string, pe double")
    joined = join_summary(bars, summary)
    assert [c for c in joined.columns if c in bars.columns] == bars.columns and "ingested_at" not in joined.columns
    got = {(r["symbol"], r["trade_date"]): r["pe"] for r in joined.collect()}
    assert len(got) == 11 and {k: v for k, v in got.items() if v is not None} == {("A", day(1)): 4.0}
    text = plan(daily_indicators(joined))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1 and "Join" not in text


@pytest.mark.parametrize("n", [1, 2047, 2048, 2049, 6500])
def test_bounded_averages_equal_joined_ones(spark, n):
    rng = random.Random(n)
    rows = [(s, i, None if rng.random() < 0.2 or i < lead else rng.uniform(-5, 5)) for s, lead in (("A", 0), ("B", 2500), ("C", 10**6)) for i in range(n)]
    df = positions(spark.createDataFrame(rows, "symbol string, t int, x double"), ["symbol"], ["t"])
    specs = {"a": ("x", SPAN_12), "b": ("x", WILDER)}
    want, got = [{(r["symbol"], r["t"]): (r["a"], r["b"]) for r in f(df, ["symbol"], specs).collect()} for f in (ema_columns, ema_columns_bounded)]
    assert len(got) == 3 * n and got.keys() == want.keys()
    for k, pair in want.items():
        assert all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9) for a, b in zip(pair, got[k]))


def test_sector_sums_are_not_shuffled_by_stock(plain):
    facts = plain.createDataFrame(
        [(k, d, 1.0, 10, 0.1, 5.0, 2.0, 3.0, 1.0) for k in (1, 2, 2, None) for d in (20240101, None)],
        "stock_key int, date_key int, close double, total_volume long, price_change_pct double, market_cap double, pe double, pb double, eps double")
    stocks = plain.createDataFrame([(1, "x"), (2, "x")], "stock_key int, sector string")
    sectors = plain.createDataFrame([(7, "x")], "sector_key int, sector string")
    out = sector_daily(facts, stocks, sectors)
    assert sorted((str(r["date_key"]), r["stock_count"], r["total_market_cap"]) for r in out.collect()) == [("20240101", 2, 15.0), ("None", 2, 15.0)]
    summed = [line for line in plan(out).splitlines() if "partial_sum" in line]
    assert summed and all("stock_key" not in line.split("functions")[0] for line in summed)


def test_few_medians_leave_the_facts_where_they_lie(plain):
    equity = plain.createDataFrame([(s, day(0), float(i)) for i, s in enumerate("ABC")], "symbol string, trade_date date, pe double")
    stocks = plain.createDataFrame([("A", "x"), ("B", "x")], "symbol string, sector string")
    out = flows.with_sector_median(equity, stocks)
    assert sorted((r["symbol"], r["pe_median_sector"]) for r in out.collect()) == [("A", 0.5), ("B", 0.5), ("C", 2.0)]
    assert not [line for line in plan(out).splitlines() if "SortMergeJoin" in line and "_group" in line]


def test_a_star_builds_what_is_asked_for(spark):
    class Tables:
        built = []

        def __getattr__(self, name):
            self.built.append(name)
            return spark.createDataFrame([(1, "A", "x", "HOSE")], "stock_key int, symbol string, sector string, exchange string")

    star = StagedStar(Tables(), dim_stock="stocks", dim_date="dates", equity="facts")
    assert serving.stock_total(star, exchange="HOSE").first()[0] == 1
    assert set(Tables.built) == {"stocks"} and isinstance(star, serving.Star) and star.news is None
