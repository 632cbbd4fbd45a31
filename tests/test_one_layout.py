"""Months of a table are laid out by one shuffle, and by none where the rows lie by months already."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from candlewright.sources import writers
from candlewright.sources.writers import Store
from workbench import mapping


@pytest.fixture
def plain(spark):
    """No broadcast and no adaptive plans: every exchange shows."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k in settings:
        spark.conf.unset(k)


def shuffles(df):
    return re.findall(r"Exchange (\w+partitioning)", df._jdf.queryExecution().executedPlan().toString())


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merge_and_layout_share_a_shuffle(plain):
    new = plain.createDataFrame([("2024-01", "A", 1), ("2024-01", "A", 0), (None, None, 7), ("2024-02", "B", 3)], "m string, k string, v int")
    old = plain.createDataFrame([("2024-01", "A", 8), ("2024-01", "C", 9), (None, None, 6)], "m string, k string, v int")
    merged = writers.merge_rows(new, old, ["k", "m"], layout=["m", "k"])
    assert shuffles(merged.sortWithinPartitions("m", "k")) == ["rangepartitioning"]
    assert rows_of(merged) == rows_of(writers.merge_rows(new, old, ["k", "m"])) == [("2024-01", "A", 0), ("2024-01", "C", 9), ("2024-02", "B", 3), (None, None, 7)]


def test_rows_that_are_staged_are_not_written_again(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("A", "2024-01", 1), ("B", "2024-02", 2)], "k string, m string, v int")
    rows.write.parquet(f"{tmp_path}/staged")
    staged = spark.read.parquet(f"{tmp_path}/staged")
    removed = []
    monkeypatch.setattr(writers, "delete", lambda s, path: removed.append(path))
    for _ in range(2):
        writers.append_merge(staged, f"{tmp_path}/t", ["k", "m"], ["m"], staged=True)
    assert removed == [] and rows_of(spark.read.parquet(f"{tmp_path}/t").select("k", "m", "v")) == rows_of(rows)


def test_months_of_a_table_go_on_without_a_shuffle(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    df = spark.range(300).select(F.col("id").alias("v"), F.format_string("2024-%02d", F.col("id") % 3 + 1).alias("m"))
    first = store.publish_parts(df, "a", "m", ["v"], checks=[])
    second = store.publish_parts(first.withColumn("w", -F.col("v")), "b", "m", ["w"], checks=[], spread=False)
    assert rows_of(second.select("v", "m")) == rows_of(df) and store.partitions("b", "m") == store.partitions("a", "m")
    assert len(second.inputFiles()) <= len(first.inputFiles())
    for f in second.inputFiles():
        found = [r["w"] for r in spark.read.parquet(f).collect()]
        assert found == sorted(found)


def test_fundamentals_take_one_shuffle(plain, tmp_path):
    lines = [(s, datetime(2024, 1, d), 10.0 * d, 2.0, 0.04, 0.02) for s in (1, 2) for d in range(2, 12) for _ in range(2)]
    plain.createDataFrame(lines, "l_suppkey long, l_shipdate timestamp_ntz, l_extendedprice double, l_quantity double, l_tax double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    plain.createDataFrame([(1, "a"), (2, "b")], "s_suppkey long, s_name string").write.parquet(f"{tmp_path}/supplier.parquet")
    summary = mapping.raw_summary(plain, str(tmp_path))
    assert shuffles(summary) == ["hashpartitioning"]
    got = {(r["symbol"], r["date"]): r for r in summary.collect()}
    assert len(got) == 16 and ("A", "2024-01-05") not in got
    assert (got["B", "2024-01-11"]["high_52w"], got["B", "2024-01-11"]["low_52w"], got["B", "2024-01-11"]["market_cap"]) == (50.0, 10.0, 220.0)
