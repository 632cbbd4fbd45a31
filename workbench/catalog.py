"""Registry of the queries: a callable for Spark and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return register


def nudge(digits: int) -> float:
    """Moves short decimals off the rounding tie, where the last bit of a double would decide."""
    return 1.37 * 10.0 ** -(digits + 2)


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c) + nudge(digits), digits) for c in columns})


def r(digits: int, *columns: str) -> str:
    """The same rounding in SQL."""
    return ", ".join(f"round({c} + {nudge(digits)!r}::DOUBLE, {digits}) AS {c.split('.')[-1]}" for c in columns)


def rx(digits: int, expression: str, name: str) -> str:
    return f"round({expression} + {nudge(digits)!r}::DOUBLE, {digits}) AS {name}"
