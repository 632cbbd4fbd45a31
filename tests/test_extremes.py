"""Highest and lowest of the rows before, without a frame of that many rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from workbench.mapping import before_extremes


@pytest.mark.parametrize("rows", [1, 2, 3, 7, 8, 252])
def test_extremes_equal_those_of_the_frame(spark, rows):
    rng = random.Random(rows)
    days = [(s, date(2020, 1, 1) + timedelta(days=i), rng.choice([None, float("nan"), rng.uniform(-9, 9), rng.uniform(-9, 9)]), rng.uniform(0, 9)) for s in ("A", "B", None) for i in range(600 if s else 5)]
    df = spark.createDataFrame(days, "symbol string, day date, x double, y double")
    by = Window.partitionBy("symbol").orderBy("day")
    frame = by.rowsBetween(-rows, -1)
    want = df.withColumns({"high": F.max("x").over(frame), "low": F.min("y").over(frame)})
    got = before_extremes(df, by, rows, {"high": "x"}, {"low": "y"})
    plain = lambda t: sorted(map(str, t.select("symbol", "day", "x", "y", "high", "low").collect()))
    assert plain(got) == plain(want)


def test_plan_has_no_long_frame(spark):
    df = spark.createDataFrame([("A", 1, 1.0)], "symbol string, day int, x double")
    plan = before_extremes(df, Window.partitionBy("symbol").orderBy("day"), 252, {"high": "x"}, {})._jdf.queryExecution().executedPlan().toString()
    assert "-252" not in plan and plan.count("Exchange hashpartitioning") == 1
