"""Batch sources."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructType

from candlewright.functions.cleanse import to_date_any
from candlewright.sources.files import exists


def scan_kind(spark: SparkSession, root: str, kind: str, schema: StructType | None = None) -> DataFrame:
    """All files of one kind under a prefix, e.g. ``ohlc.parquet`` beside ``summary.parquet``.

    Columns a file lacks are null; files that cannot be read are skipped.
    """
    reader = (
        spark.read.option("pathGlobFilter", kind).option("mergeSchema", True).option("ignoreCorruptFiles", True)
        .option("recursiveFileLookup", False).option("basePath", root)
    )
    return (reader.schema(schema) if schema is not None else reader).parquet(root)


def only_day(df: DataFrame, day: str) -> DataFrame:
    """Rows of one day partition; the filter prunes directories."""
    year, month, date = day.split("-")
    return df.where((F.col("year") == year) & (F.col("month") == month) & (F.col("day") == date))


def scan_groups(
    spark: SparkSession, groups: Sequence[str | DataFrame], date_columns: Sequence[str] = ("date",)
) -> DataFrame:
    """Union of groups of files whose date columns differ in type, read as dates each in its own way."""
    frames = [g if isinstance(g, DataFrame) else spark.read.parquet(g) for g in groups]
    aligned = [
        f.withColumns({c: to_date_any(c, f.schema[c].dataType) for c in date_columns if c in f.columns}) for f in frames
    ]
    return union_all(aligned)


def _footers(batches):
    """Path and column types of every file, from its footer alone; null where there is none to read."""
    for batch in batches:
        paths, found = batch.column(0).to_pylist(), []
        for path in paths:
            try:
                fs, where = pafs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", path))
                with fs.open_input_file(where) as opened:
                    schema = pq.read_schema(opened)
            except (OSError, pa.ArrowException):
                found.append(None)
                continue
            # Nanoseconds have no type in Spark: such columns are read as numbers.
            nanos = {f.name for f in schema if pa.types.is_timestamp(f.type) and f.type.unit == "ns"}
            kinds = {f.name: "nanos" if f.name in nanos else from_arrow_type(f.type).simpleString() for f in schema}
            found.append(json.dumps(kinds, sort_keys=True))
        yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], ["path", "kinds"])


def scan_drifting(
    spark: SparkSession, root: str, pattern: str = "*.parquet", date_columns: Sequence[str] = ("date",)
) -> DataFrame:
    """All Parquet files of a folder whose columns differ in type from file to file, by the folder's path alone.

    Footers are read in parallel, files are grouped by their column types, and each group is one scan that brings the
    date columns to dates in its own way. Columns a file lacks are null; files without a readable footer are left out;
    folder names such as ``year=2024`` become columns. Other columns that differ are widened by the union, or read as text.
    Footers are read through ``pyarrow.fs``, so the folder has to lie on a file system that it knows; listing and rows are Spark's.
    """
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(root).select("path")
    groups = (
        listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "path").mapInArrow(_footers, "path string, kinds string")
        .where("kinds is not null").groupBy("kinds").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("kinds").collect()
    )
    if not groups:
        return spark.createDataFrame([], "date date")
    kinds = [json.loads(g["kinds"]) for g in groups]
    # Outside the dates a column keeps its type where all files agree, becomes a double where all hold numbers, else text.
    types: dict[str, set[str]] = {}
    for k in kinds:
        for name, kind in k.items():
            types.setdefault(name, set()).add(kind)
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    common = {n: "double" if t <= numbers else "string" for n, t in types.items() if len(t) > 1 and n not in date_columns}
    frames = []
    for k, g in zip(kinds, groups):
        ddl = ", ".join(f"`{n}` {'bigint' if t == 'nanos' else t}" for n, t in k.items())
        rows = spark.read.option("basePath", root).schema(ddl).parquet(*g["paths"])
        rows = rows.withColumns({n: F.timestamp_micros(F.expr(f"`{n}` div 1000")) for n, t in k.items() if t == "nanos"})
        frames.append(rows.withColumns({n: F.col(n).cast(t) for n, t in common.items() if n in k}))
    return scan_groups(spark, frames, date_columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def project_distinct(frames: Sequence[DataFrame], columns: Sequence[str]) -> DataFrame:
    """The wanted columns each frame has, whole rows distinct."""
    return union_all([f.select(*[c for c in columns if c in f.columns]) for f in frames]).distinct()


def optional_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A table that may be absent or unreadable: then it is empty, with its columns."""
    if exists(spark, path):
        try:
            return spark.read.parquet(path)
        except AnalysisException:
            pass
    return spark.createDataFrame([], schema)
