"""Every registered query on the smallest given tables against its SQL counterpart in DuckDB."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from workbench.check import TABLES, compare

DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return connection


@pytest.mark.parametrize("name", list(entry.QUERIES))
def test_query(spark, con, name):
    line = compare(spark, con, DIR, name)
    assert line.startswith(("ok", "rows")), line


def test_every_query_has_sql():
    assert set(entry.QUERIES) == set(entry.ORACLES)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert 0 < len(rows) <= 10
    assert [r["price_change_pct"] for r in rows] == sorted((r["price_change_pct"] for r in rows), reverse=True)
