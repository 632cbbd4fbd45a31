"""Cooldown of alerts: after one fires, the same kind stays silent for a while.

Which alert fires depends on the last one that fired, so the candidates of a key form chains: each points to the first
candidate at least the cooldown later, and those that fire are the ones met on the way from a start. A candidate that
comes a cooldown or more after the one before it always fires: it starts a chain of its own.

Chains are followed by pointer doubling. After round r every candidate points 2**r steps ahead and all candidates up to
2**r steps from a start are known to fire; a round is one join of the candidates with themselves, by key and time. No
candidates of a key are collected, and a key that never pauses needs log2(its length / cooldown) rounds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewright.operators.series import time_bounds, with_range
from candlewright.session import pinned


def _started(times: DataFrame, wait: int) -> DataFrame:
    """(_k, _t, _start): whether the candidate before lies ``wait`` or more back. ``times`` holds distinct (_k, _t, _range)."""
    ends = times.groupBy("_k", "_range").agg(F.max("_t").alias("_last"))
    before = ends.select("_k", "_range", F.lag("_last").over(Window.partitionBy("_k").orderBy("_range")).alias("_before"))
    inside = Window.partitionBy("_k", "_range").orderBy("_t")
    previous = F.coalesce(F.lag("_t").over(inside), F.col("_before"))
    return times.join(before, ["_k", "_range"]).select("_k", "_t", F.coalesce(F.col("_t") - previous >= wait, F.lit(True)).alias("_start"))


def _with_next(started: DataFrame, wait: int, bounds: Sequence[float]) -> DataFrame:
    """(_k, _t, _start, _next): the first candidate ``wait`` or more later; null too where that one starts a chain.

    Inside a range of time a window finds it, walking back from the latest; across ranges one row per key and range does.
    """
    asked = started.select("_k", "_t", "_start", (F.col("_t") + wait).alias("_at"), F.lit(1).alias("_kind"))
    answers = started.select("_k", F.col("_t").alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col("_t").alias("at"), F.col("_start").alias("start")).alias("_answer"))
    both = asked.unionByName(answers, allowMissingColumns=True).withColumn("_when", F.timestamp_micros("_at"))
    ranged = with_range(both, "_when", bounds).drop("_when")
    heads = ranged.groupBy("_k", "_range").agg(F.min("_answer").alias("_head"))
    later = Window.partitionBy("_k").orderBy(F.col("_range").desc()).rowsBetween(Window.unboundedPreceding, -1)
    following = heads.select("_k", "_range", F.last("_head", ignorenulls=True).over(later).alias("_following"))
    back = Window.partitionBy("_k", "_range").orderBy(F.col("_at").desc(), "_kind").rowsBetween(Window.unboundedPreceding, -1)
    found = ranged.withColumn("_here", F.last("_answer", ignorenulls=True).over(back)).where("_kind = 1")
    answer = F.coalesce("_here", "_following")
    return found.join(following, ["_k", "_range"]).select("_k", "_t", "_start", F.when(~answer["start"], answer["at"]).alias("_next"))


def apply_cooldown(
    alerts: DataFrame,
    seconds: int = 300,
    key: Sequence[str] = ("symbol", "alert_type"),
    time: str = "alert_time",
) -> DataFrame:
    """Alerts that fire: the first of a key, then each at least ``seconds`` after the last fired.

    Equal alerts fire together; a null in the key is a value like others. Runs jobs while it is called: the candidates are
    written once, and the pointers after each round.
    """
    wait = int(seconds * 1_000_000)
    if wait <= 0:
        return alerts
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    # Keys as one value, so that nulls meet in the joins.
    timed = pinned(alerts.withColumns({"_k": F.to_json(F.struct(*key)), "_t": micros}))
    times = timed.select("_k", "_t", F.timestamp_micros("_t").alias("_when")).where(F.col("_t").isNotNull()).distinct()
    bounds = time_bounds(times, "_when")
    started = _started(with_range(times, "_when", bounds).drop("_when"), wait)
    nodes = pinned(_with_next(started, wait, bounds).withColumnRenamed("_start", "_fires"))
    # A chain fires at most once per cooldown.
    steps = nodes.agg((F.max("_t") - F.min("_t")) / wait).first()[0] or 0
    covered = 1
    while covered <= steps + 1:
        ahead = nodes.where(F.col("_next").isNotNull())
        hit = ahead.where("_fires").select("_k", F.col("_next").alias("_t")).distinct().withColumn("_hit", F.lit(True))
        jump = nodes.select("_k", F.col("_t").alias("_next"), F.col("_next").alias("_beyond"))
        fired = nodes.join(hit, ["_k", "_t"], "left").withColumn("_fires", F.col("_fires") | F.col("_hit").isNotNull()).drop("_hit")
        nodes = pinned(fired.join(jump, ["_k", "_next"], "left").select("_k", "_t", "_fires", F.col("_beyond").alias("_next")))
        covered *= 2
        if nodes.where(F.col("_next").isNotNull()).isEmpty():
            break
    fires = nodes.where("_fires").select("_k", "_t")
    return timed.join(fires, ["_k", "_t"], "left_semi").drop("_k", "_t")
