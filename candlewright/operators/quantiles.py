"""Exact quantiles without holding a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.session import pinned

METHODS = ("linear", "nearest", "lower", "higher", "midpoint")


def exact_quantiles(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    probs: Sequence[float],
    names: Sequence[str],
    method: str = "linear",
) -> DataFrame:
    """Quantiles of ``value`` per group, equal to sorting the group and reading off the ranks.

    The distinct values of all groups, with their counts, are range-partitioned by group and value, so a large
    group spreads over many tasks wherever its values lie. Ranks are running counts inside a partition plus the counts of
    the partitions before, one small row per partition and group. Nulls and NaN are left out; infinities are values.
    Without ``by`` there is always one row.
    """
    if method not in METHODS:
        raise ValueError(f"unknown quantile method {method!r}; known are {', '.join(METHODS)}")
    by = list(by)
    x = F.col(value).cast("double")
    rows = df.where(x.isNotNull() & ~F.isnan(x)).select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(by)], x.alias("_x"))
    keys = [f"_g{i}" for i in range(len(by))]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = rows.groupBy(*keys, "_x").agg(F.count(F.lit(1)).alias("_c"))
    # Pinned, because both branches below must see the same partitions.
    ranged = pinned(counted.repartitionByRange(parts, *keys, "_x").withColumn("_part", F.spark_partition_id()))
    spans = ranged.groupBy(*keys, "_part").agg(F.sum("_c").alias("_n"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    placed = spans.withColumns({"_before": F.coalesce(F.sum("_n").over(earlier), F.lit(0)), "_total": F.sum("_n").over(whole)})
    renamed = {k: f"_r{k}" for k in [*keys, "_part"]}
    same = F.lit(True)
    for k, other in renamed.items():
        same = same & F.col(k).eqNullSafe(F.col(other))
    upto = Window.partitionBy(*keys, "_part").orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = (
        ranged.join(placed.drop("_n").withColumnsRenamed(renamed), same).drop(*renamed.values())
        .withColumn("_end", F.col("_before") + F.sum("_c").over(upto)).withColumn("_start", F.col("_end") - F.col("_c"))
    )
    return _pick(ranked, keys, probs, names, method).select(*[F.col(k).alias(n) for k, n in zip(keys, by)], *names)


def _ranks(p: float, method: str) -> tuple[Column, Column, Column]:
    """Lower rank, upper rank and the weight of the upper one, from the group's ``_total``."""
    at = (F.col("_total") - 1) * F.lit(float(p))
    low, high = F.floor(at), F.ceil(at)
    if method == "nearest":
        low = high = F.rint(at).cast("bigint")
    elif method == "lower":
        high = low
    elif method == "higher":
        low = high
    share = F.lit(0.5) if method == "midpoint" else at - low
    return low, high, F.when(low == high, F.lit(0.0)).otherwise(share)


def _pick(ranked: DataFrame, by: Sequence[str], probs: Sequence[float], names: Sequence[str], method: str) -> DataFrame:
    picks, blend = [], []
    for i, (p, name) in enumerate(zip(probs, names)):
        low, high, share = _ranks(p, method)
        for tag, rank in (("l", low), ("h", high)):
            inside = (rank >= F.col("_start")) & (rank < F.col("_end"))
            picks.append(F.max(F.when(inside, F.col("_x"))).alias(f"_{tag}{i}"))
        picks.append(F.max(share).alias(f"_w{i}"))
        low_x, high_x = F.col(f"_l{i}"), F.col(f"_h{i}")
        # Equal ends first: the difference of two infinities is no number.
        blend.append(F.when(low_x == high_x, low_x).otherwise(low_x + (high_x - low_x) * F.col(f"_w{i}")).alias(name))
    return ranked.groupBy(*by).agg(*picks).select(*by, *blend)
