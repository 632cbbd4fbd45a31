"""Run checks on a frame: a report, a pass-through check, a gate before a write."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from candlewright.quality.checks import CHECKS, Config, Measure

Check = tuple[str, Config]
SAMPLE_ROWS = 20
REPORT_COLUMNS = ["success", "element_count", "unexpected_count", "unexpected_percent", "observed_value"]


class QualityError(ValueError):
    """Raised by a gate; names every failed check. ``samples`` holds up to ``SAMPLE_ROWS`` violating rows of each, as JSON."""

    def __init__(self, message: str, samples: dict[tuple[str, str], list[str]] | None = None):
        super().__init__(message)
        self.samples = samples or {}


def _rows(source: DataFrame, measures: Sequence[tuple[str, Measure]]) -> DataFrame:
    """One report row per measure from one aggregate over ``source``."""
    aggregates, verdicts = {}, []
    for i, (name, m) in enumerate(measures):
        aggregates.update({f"_{i}_{k}": a for k, a in m.aggregates.items()})
        got = m.judge(lambda k, i=i: F.col(f"_{i}_{k}"))
        verdicts.append(F.struct(
            F.lit(name).alias("check"), F.lit(m.column).alias("column"), *[got[c].alias(c) for c in REPORT_COLUMNS]
        ))
    totals = source.agg(*[a.alias(k) for k, a in aggregates.items()])
    return totals.select(F.explode(F.array(*verdicts)).alias("_r")).select("_r.*")


def measured(df: DataFrame, checks: Sequence[Check]) -> list[tuple[str, Measure]]:
    for name, _ in checks:
        if name not in CHECKS:
            raise KeyError(f"unknown check {name!r}")
    return [(name, m) for name, config in checks for m in CHECKS[name](df, config)]


def report(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """(check, column, success, element_count, unexpected_count, unexpected_percent, observed_value)."""
    return _report(df, measured(df, checks))


def _report(df: DataFrame, measures: Sequence[tuple[str, Measure]]) -> DataFrame:
    direct, counted, apart = [], {}, []
    for name, m in measures:
        if m.source is not None:
            apart.append(_rows(m.source, [(name, m)]))
        elif m.keys is not None:
            counted.setdefault(m.keys, []).append((name, m))
        else:
            direct.append((name, m))
    parts = [_rows(df, direct)] if direct else []
    for keys, some in counted.items():
        parts.append(_rows(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")), some))
    return reduce(DataFrame.unionByName, parts + apart)


def _violating(df: DataFrame, m: Measure) -> DataFrame | None:
    if m.bad is not None:
        return df.where(m.bad)
    return None if m.rows is None else m.rows(df)


def _samples(df: DataFrame, measures: Sequence[tuple[str, Measure]], failed: set[tuple[str, str]], n: int) -> dict[tuple[str, str], list[str]]:
    """Up to ``n`` violating rows per failed check; checks of a figure of the whole column have none."""
    found: dict[tuple[str, str], list[str]] = {}
    for name, m in measures:
        key = (name, m.column)
        rows = _violating(df, m) if key in failed and len(found.get(key, [])) < n else None
        if rows is not None:
            found.setdefault(key, []).extend(r[0] for r in rows.select(F.to_json(F.struct("*"))).limit(n - len(found.get(key, []))).collect())
    return found


def report_with_samples(df: DataFrame, checks: Sequence[Check], n: int = SAMPLE_ROWS) -> DataFrame:
    """The report with a column ``sample``: up to ``n`` violating rows of a failed check, as JSON.

    Runs the report, and for every failed check a search that ends as soon as it has its rows.
    """
    measures = measured(df, checks)
    rows = _report(df, measures)
    made = rows.collect()
    found = _samples(df, measures, {(r["check"], r["column"]) for r in made if not r["success"]}, n)
    schema = StructType([*rows.schema.fields, StructField("sample", ArrayType(StringType()))])
    return df.sparkSession.createDataFrame([(*r, found.get((r["check"], r["column"]), []) if not r["success"] else []) for r in made], schema)


def gate(df: DataFrame, checks: Sequence[Check], table: str = "frame") -> DataFrame:
    """The frame itself if every check passes, else an error that lists all failures with sample rows.

    The report holds one row per check, which is all that is brought to the driver, and the samples of those that failed.
    """
    measures = measured(df, checks)
    failed = _report(df, measures).where(~F.col("success")).collect()
    if failed:
        found = _samples(df, measures, {(r["check"], r["column"]) for r in failed}, SAMPLE_ROWS)
        lines = []
        for r in failed:
            rows = found.get((r["check"], r["column"]), [])
            lines.append(f"{r['check']}({r['column']}): {r['unexpected_count']} unexpected, observed {r['observed_value']}" + (", rows " + " ".join(x[:300] for x in rows) if rows else ""))
        raise QualityError(f"{table} fails {len(lines)} checks: " + "; ".join(lines), found)
    return df


def check(df: DataFrame, name: str, **config: Any) -> DataFrame:
    return gate(df, [(name, config)])


def unexpected_rows(df: DataFrame, name: str, n: int = SAMPLE_ROWS, **config: Any) -> DataFrame:
    """Up to ``n`` rows that violate a check of rows, of groups or of uniqueness."""
    measures = CHECKS[name](df, config)
    bad: Column | None = None
    for m in measures:
        if m.bad is not None:
            bad = m.bad if bad is None else bad | m.bad
        elif m.rows is not None:
            return m.rows(df).limit(n)
    if bad is None:
        raise ValueError(f"{name} has no violating rows of its own")
    return df.where(bad).limit(n)
