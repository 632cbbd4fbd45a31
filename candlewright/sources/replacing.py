"""Tables in which the row loaded last wins, per key.

A table is a base, partitioned into ranges of one of its key columns, and deltas, one folder per load. Loading writes a
delta and nothing else. Readers take the deltas and those base rows that no delta replaces. ``compact`` brings the deltas
into the base: only ranges that a delta touches are rewritten, each swapped in whole. Until the deltas are deleted they
say the same as the base, so a lost driver at any point leaves a table that reads right.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from uuid import uuid4

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, NumericType, StructField, StructType

from candlewright.functions.cleanse import one_per_key
from candlewright.schemas import REPLACING_KEYS, STAR_TABLES
from candlewright.sources.files import delete, exists, heal, partition_values, swap_in, swap_partitions
from candlewright.sources.writers import align_to_schema

RANGE, VERSION = "_range", "_version"


class ReplacingTable:
    """``cluster`` is the key column whose ranges the base is cut into: numbers, dates or any text (by its hash).

    Where a key holds a date it is the best choice, since loads are about new days.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], cluster: str | None = None, ranges: int = 64):
        self.spark, self.path, self.schema, self.keys, self.ranges = spark, path.rstrip("/"), schema, list(keys), ranges
        dated = [k for k in keys if k.endswith("date_key")]
        self.cluster = cluster or (dated or self.keys)[0]
        self.base, self.deltas = f"{self.path}/base", f"{self.path}/delta"

    def _number(self):
        kind = self.schema[self.cluster].dataType
        if isinstance(kind, DateType):
            return F.unix_date(self.cluster).cast("double")
        return F.col(self.cluster).cast("double") if isinstance(kind, NumericType) else F.xxhash64(self.cluster).cast("double")

    def _ranged(self, rows: DataFrame, bounds: Sequence[float]) -> DataFrame:
        cut = Bucketizer(splits=[-math.inf, *bounds, math.inf], inputCol="_number", outputCol="_bucket", handleInvalid="keep")
        numbered = rows.withColumn("_number", self._number())
        return (cut.transform(numbered) if bounds else numbered.withColumn("_bucket", F.lit(0))).withColumn(RANGE, F.col("_bucket").cast("int")).drop("_number", "_bucket")

    def _unique(self, df: DataFrame) -> DataFrame:
        return one_per_key(align_to_schema(df, self.schema), self.keys)

    def versions(self) -> list[int]:
        return sorted(map(int, partition_values(self.spark, self.deltas, VERSION)))

    def _write_base(self, rows: DataFrame, path: str, bounds: Sequence[float]) -> None:
        sort = [RANGE, *self.keys]
        self._ranged(rows, bounds).repartitionByRange(*sort).sortWithinPartitions(*sort).write.partitionBy(RANGE).parquet(path)

    def replace(self, df: DataFrame) -> dict[str, int | bool]:
        """Full refresh: rows that ``df`` doesn't hold are gone. Returns source_rows, loaded_rows and verified."""
        staged = f"{self.path}__{uuid4().hex}"
        cuts = [i / self.ranges for i in range(1, self.ranges)]
        bounds = df.transform(lambda x: align_to_schema(x, self.schema)).agg(F.percentile_approx(self._number(), cuts, 10 * self.ranges)).first()[0]
        bounds = sorted(set(bounds or []))
        self._write_base(self._unique(df), f"{staged}/base", bounds)
        self.spark.createDataFrame([(json.dumps(bounds),)], "bounds string").coalesce(1).write.text(f"{staged}/bounds")
        checked = self._verified(df, self.spark.read.schema(self.schema).parquet(f"{staged}/base").count())
        heal(self.spark, self.path)
        swap_in(self.spark, staged, self.path)
        return checked

    def _verified(self, df: DataFrame, loaded: int) -> dict[str, int | bool]:
        """Keys of the source against rows written."""
        source = align_to_schema(df, self.schema).select(*self.keys).distinct().count()
        return {"source_rows": source, "loaded_rows": loaded, "verified": source == loaded}

    def upsert(self, df: DataFrame) -> dict[str, int | bool]:
        """Load rows beside the others: of a key the row of the last load counts. Returns source_rows, loaded_rows and verified."""
        heal(self.spark, self.path)
        version = max([0, *self.versions()]) + 1
        staged = f"{self.path}__{uuid4().hex}"
        self._unique(df).repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write.parquet(f"{staged}/{VERSION}={version}")
        loaded = self.spark.read.schema(self.schema).parquet(f"{staged}/{VERSION}={version}").count()
        if exists(self.spark, self.deltas):
            swap_partitions(self.spark, staged, self.deltas)
        else:
            swap_in(self.spark, staged, self.deltas)
        return self._verified(df, loaded)

    def _base(self) -> DataFrame | None:
        if not partition_values(self.spark, self.base, RANGE):
            return None
        return self.spark.read.schema(StructType([*self.schema.fields, StructField(RANGE, IntegerType())])).parquet(self.base)

    def _delta(self) -> DataFrame | None:
        """The deltas, one row per key."""
        if not self.versions():
            return None
        rows = self.spark.read.schema(StructType([*self.schema.fields, StructField(VERSION, IntegerType())])).parquet(self.deltas)
        newest = F.row_number().over(Window.partitionBy(*self.keys).orderBy(F.col(VERSION).desc()))
        return rows.withColumn("_k", newest).where("_k = 1").drop("_k", VERSION)

    def _kept(self, base: DataFrame, delta: DataFrame) -> DataFrame:
        """Base rows that no delta replaces; null keys meet."""
        names = [f"_key{i}" for i in range(len(self.keys))]
        same = [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(self.keys, names)]
        condition = same[0]
        for s in same[1:]:
            condition = condition & s
        return base.join(delta.select(*[F.col(k).alias(n) for k, n in zip(self.keys, names)]), condition, "left_anti")

    def read(self) -> DataFrame:
        heal(self.spark, self.path)
        base, delta = self._base(), self._delta()
        if base is None:
            return delta if delta is not None else self.spark.createDataFrame([], self.schema)
        base = base.drop(RANGE)
        return base if delta is None else self._kept(base, delta).unionByName(delta)

    def compact(self) -> list[int]:
        """Bring the deltas into the base; returns the ranges that were rewritten."""
        heal(self.spark, self.path)
        delta, base = self._delta(), self._base()
        if delta is None:
            return []
        if base is None:
            self.replace(delta)
            return []
        done = self.versions()
        bounds = json.loads(self.spark.read.text(f"{self.path}/bounds").first()[0])
        ranged = self._ranged(delta, bounds)
        # One number per touched range, of which a table has ``ranges``.
        touched = sorted(r[0] for r in ranged.select(RANGE).distinct().collect())
        staged = f"{self.path}__{uuid4().hex}"
        merged = self._kept(base.where(F.col(RANGE).isin(touched)), delta).drop(RANGE).unionByName(delta)
        self._write_base(merged, staged, bounds)
        swap_partitions(self.spark, staged, self.base)
        for version in done:
            delete(self.spark, f"{self.deltas}/{VERSION}={version}")
        return touched


def star_table(spark: SparkSession, root: str, name: str, ranges: int = 64) -> ReplacingTable:
    """One of the tables of the star, by its name, with the schema and key that it is loaded by."""
    return ReplacingTable(spark, f"{root.rstrip('/')}/{name}", STAR_TABLES[name], REPLACING_KEYS[name], ranges=ranges)
