"""Replacing tables against a plain dictionary."""

import os
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewright import schemas
from candlewright.sources.replacing import ReplacingTable, star_table


def value(kind, i):
    if isinstance(kind, T.DateType):
        return date(2024, 1, 1) + timedelta(days=i % 900)
    if isinstance(kind, T.BooleanType):
        return i % 2 == 0
    if isinstance(kind, T.IntegralType):
        return i % 100
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return i / 4
    return f"text {i}"


def rows_for(name, numbers, shift=0):
    """Rows whose key is made of the number alone; the other columns move with ``shift``."""
    keys = schemas.REPLACING_KEYS[name]
    out = []
    for i in numbers:
        cells = []
        for f in schemas.STAR_TABLES[name].fields:
            if f.name not in keys:
                cells.append(value(f.dataType, i + shift))
            elif isinstance(f.dataType, T.IntegralType):
                cells.append(i)
            else:
                cells.append(value(f.dataType, i))
        out.append(tuple(cells))
    return out


@pytest.mark.parametrize("name", sorted(schemas.STAR_TABLES))
def test_every_star_table_loads_reloads_and_reads(spark, tmp_path, name):
    schema, table = schemas.STAR_TABLES[name], star_table(spark, str(tmp_path), name, 10)
    frame = lambda rows: spark.createDataFrame(rows, schema).withColumn("not_in_target", F.lit(1))
    assert table.read().count() == 0
    assert table.replace(frame(rows_for(name, range(200)))) == {"source_rows": 200, "loaded_rows": 200, "verified": True}
    assert table.upsert(frame(rows_for(name, range(190, 210), 7)))["verified"]
    want = sorted(rows_for(name, range(190)) + rows_for(name, range(190, 210), 7))
    assert sorted(map(tuple, table.read().collect())) == want
    touched = table.compact()
    assert 1 <= len(touched) <= 2 and table.versions() == []
    assert sorted(map(tuple, table.read().collect())) == want
    assert table.read().schema == T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])


def test_a_small_reload_rewrites_little(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.DoubleType())])
    table = ReplacingTable(spark, str(tmp_path / "t"), schema, ["k"], ranges=100)
    table.replace(spark.range(20_000).select(F.col("id").alias("k"), F.lit(0.0).alias("v")))
    files = lambda: {os.path.join(d, f): os.stat(os.path.join(d, f)).st_ino for d, _, fs in os.walk(tmp_path / "t/base") for f in fs if f.endswith(".parquet")}
    before = files()
    table.upsert(spark.range(5_000, 5_200).select(F.col("id").alias("k"), F.lit(1.0).alias("v")))
    assert files() == before and table.read().where("v = 1").count() == 200
    assert len(table.compact()) <= 2
    assert len(before.items() - files().items()) <= 2 and table.read().count() == 20_000 and table.read().where("v = 1").count() == 200


def test_random_loads(spark, tmp_path):
    rng, want = random.Random(3), {}
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.IntegerType()), T.StructField("v", T.IntegerType())])
    table = ReplacingTable(spark, str(tmp_path / "t"), schema, ["a", "b"], ranges=5)
    for step in range(5):
        rows = {(rng.choice(["x", "y", None]), rng.choice([1, 2, 3, None])): rng.randint(0, 99) for _ in range(6)}
        table.upsert(spark.createDataFrame([(a, b, v) for (a, b), v in rows.items()], schema))
        want |= rows
        if step in (1, 3):
            table.compact()
        assert {(r["a"], r["b"]): r["v"] for r in table.read().collect()} == want and table.read().count() == len(want)


def test_a_lost_driver_leaves_a_right_table(spark, tmp_path, monkeypatch):
    from candlewright.sources import replacing

    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    table = ReplacingTable(spark, str(tmp_path / "t"), schema, ["k"], ranges=4)
    table.replace(spark.range(100).selectExpr("id AS k", "0L AS v"))
    table.upsert(spark.range(50, 150).selectExpr("id AS k", "1L AS v"))

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(replacing, "delete", lost)
    with pytest.raises(RuntimeError):
        table.compact()
    monkeypatch.undo()
    read = lambda: sorted(map(tuple, table.read().collect()))
    want = [(i, int(i >= 50)) for i in range(150)]
    assert read() == want
    table.compact()
    assert read() == want and table.versions() == []
