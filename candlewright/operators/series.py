"""Ordered work on long per-key series without putting a whole key into one task.

A symbol may own a large share of all rows, so no window here is partitioned by the key alone
unless the series is bounded by the calendar. Three building blocks are enough:

* ``time_bounds``    cuts time where the rows are: between two bounds lies about the same number of rows, so not even
                     a symbol that has all rows of an hour, or of the table, puts more than that into one window;
* ``positions``      numbers the rows of every key (counts per time bucket, then ranks inside it);
* ``blocks``         cuts the numbered rows into blocks that overlap by a fixed number of rows, so
                     any frame no longer than the overlap can be evaluated inside one block;
* ``running_totals`` prefix sums in two levels: totals per time bucket, then sums inside it.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
_BLOCK = "_block"
_CORE = "_core"
_POS = "_pos"


def time_bounds(df: DataFrame, time: str, parts: int | None = None) -> list[float]:
    """Microseconds that cut the times of ``df`` into ranges of about equally many rows, by approximate quantiles.

    Runs a job that reads the time column only. Any frame of the same times will do: bounds decide how work is dealt out,
    never what comes out. ``parts`` ranges, four for every shuffle partition if not given, 10,000 at most.
    """
    spark = df.sparkSession
    parts = min(10_000, parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    micros = F.unix_micros(F.col(time).cast("timestamp")).cast("double")
    cuts = [i / parts for i in range(1, parts)]
    found = df.agg(F.percentile_approx(micros, cuts, 10 * parts).alias("cuts")).first()["cuts"]
    return sorted(set(found or []))


def with_range(df: DataFrame, time: str, bounds: Sequence[float], name: str = "_range") -> DataFrame:
    """Add the number of the range that a row's time lies in; numbers grow with time."""
    if not bounds:
        return df.withColumn(name, F.lit(0))
    splits = [-math.inf, *bounds, math.inf]
    cut = Bucketizer(splits=splits, inputCol="_micros", outputCol=name, handleInvalid="keep")
    return cut.transform(df.withColumn("_micros", F.unix_micros(F.col(time).cast("timestamp")).cast("double"))).drop("_micros")


def positions(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``_pos``, the zero-based position of a row inside its key.

    Without ``bucket`` each key is ranked in one window: use it only where a key is bounded, as with
    one row per trading day. With ``bucket`` (non-decreasing in ``order``: the range of ``with_range``) only the
    rows of one bucket meet in a task; the counts of earlier buckets give the offset.
    """
    if bucket is None:
        rank = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
        return df.withColumn(_POS, rank.cast("long") - 1)
    tagged = df.withColumn("_bucket", bucket)
    counts = tagged.groupBy(*key, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*key, "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy(*key, "_bucket").orderBy(*order))
    return (
        tagged.join(base, [*key, "_bucket"])
        .withColumn(_POS, F.col("_base") + rank - 1)
        .drop("_base", "_bucket")
    )


def blocks(df: DataFrame, halo: int, size: int = BLOCK_ROWS) -> DataFrame:
    """Assign positioned rows to blocks; the last ``halo`` rows of a block also open the next one."""
    if not 0 <= halo <= size:
        raise ValueError(f"halo {halo} must lie between 0 and the block size {size}")
    own = F.expr(f"{_POS} div {size}")
    shared = F.col(_POS) % size >= size - halo
    homes = F.when(shared, F.array(own, own + 1)).otherwise(F.array(own))
    return df.withColumn(_BLOCK, F.explode(homes)).withColumn(
        _CORE, F.col(_BLOCK) == F.expr(f"{_POS} div {size}")
    )


def block_window(key: Sequence[str]) -> WindowSpec:
    return Window.partitionBy(*key, _BLOCK).orderBy(_POS)


def drop_halo(df: DataFrame, keep_positions: bool = False) -> DataFrame:
    return df.where(_CORE).drop(_BLOCK, _CORE, *([] if keep_positions else [_POS]))


def _span(alpha: float) -> int:
    """Values after which the weight (1 - alpha)**n is e**-600: far below double precision, and its inverse still finite."""
    return max(1, int(600 / -math.log1p(-alpha)))


def ema_columns(df: DataFrame, key: Sequence[str], specs: Mapping[str, tuple[str, float]]) -> DataFrame:
    """Recursive averages y[t] = (1-a) y[t-1] + a x[t], seeded by the first non-null value.

    ``specs`` maps an output name to (value column, alpha); ``df`` carries ``_pos``. A null value repeats the previous
    average; before the first value the average is null. Nothing is cut: the rows of a key are dealt into buckets by
    position, a bucket yields its count n of values and its end s, as if it began at zero, and the true end follows from
    y -> (1-a)**n y + s. These one-row buckets are chained by the same rule in a window over their counts, and what a
    bucket starts from is joined back. Any number of nulls and any smoothing factor in (0, 1) will do.
    """
    size = min(BLOCK_ROWS, *[_span(a) for _, a in specs.values()])
    bucketed = df.withColumn("_bucket", F.expr(f"{_POS} div {size}"))
    inside = Window.partitionBy(*key, "_bucket").orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    values = sorted({value for value, _ in specs.values()})
    counted = bucketed.withColumns({f"_n_{v}": F.count(v).over(inside) for v in values})
    parts = {}
    for name, (value, alpha) in specs.items():
        n, decay = F.col(f"_n_{value}"), F.lit(1.0 - alpha)
        parts[f"_s_{name}"] = F.coalesce(F.sum(alpha * F.col(value) * F.pow(decay, -n)).over(inside) * F.pow(decay, n), F.lit(0.0))
    summed = counted.withColumns(parts)
    ends = summed.groupBy(*key, "_bucket").agg(
        *[F.max(f"_n_{v}").alias(f"_c_{v}") for v in values],
        *[F.min_by(v, F.when(F.col(v).isNotNull(), F.col(_POS))).alias(f"_f_{v}") for v in values],
        *[F.max_by(f"_s_{name}", _POS).alias(f"_e_{name}") for name in specs],
    )
    # One row per bucket from here: a key has as many as its rows over ``size``.
    along = Window.partitionBy(*key).orderBy("_bucket")
    upto, before = along.rowsBetween(Window.unboundedPreceding, Window.currentRow), along.rowsBetween(Window.unboundedPreceding, -1)
    chained = ends.withColumns({f"_t_{v}": F.sum(f"_c_{v}").over(upto) for v in values} | {
        f"_seed_{v}": F.first(f"_f_{v}", ignorenulls=True).over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) for v in values
    })
    carried = {}
    for name, (value, alpha) in specs.items():
        decay, total = F.lit(1.0 - alpha), F.col(f"_t_{value}")
        group = f"_g_{name}"
        chained = chained.withColumn(group, F.floor(total / _span(alpha)))
        local = total - F.col(group) * _span(alpha)
        same = Window.partitionBy(*key, group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        chained = chained.withColumn(f"_l_{name}", F.sum(F.col(f"_e_{name}") * F.pow(decay, -local)).over(same) * F.pow(decay, local))
        # Of earlier groups only the last still weighs anything: the one before it ends more than a span of values back.
        closes = F.coalesce(F.lead(group).over(along) > F.col(group), F.lit(False))
        chained = chained.withColumns({f"_pl_{name}": F.when(closes, F.col(f"_l_{name}")), f"_pt_{name}": F.when(closes, total)})
        older = F.last(f"_pl_{name}", ignorenulls=True).over(before) * F.pow(decay, total - F.last(f"_pt_{name}", ignorenulls=True).over(before))
        end = F.col(f"_l_{name}") + F.coalesce(older, F.lit(0.0)) + F.pow(decay, total) * F.col(f"_seed_{value}")
        carried[f"_y_{name}"] = F.when(F.coalesce(F.lag(f"_t_{value}").over(along), F.lit(0)) == 0, F.col(f"_seed_{value}")).otherwise(F.lag(end).over(along))
    starts = chained.withColumns(carried).select(
        *key, "_bucket", *carried, *[(F.col(f"_t_{v}") - F.col(f"_c_{v}")).alias(f"_b_{v}") for v in values]
    )
    out = {
        name: F.when(
            F.col(f"_n_{value}") + F.col(f"_b_{value}") > 0,
            F.col(f"_s_{name}") + F.pow(F.lit(1.0 - alpha), F.col(f"_n_{value}")) * F.col(f"_y_{name}"),
        ) for name, (value, alpha) in specs.items()
    }
    scratch = [f"_n_{v}" for v in values] + [f"_b_{v}" for v in values] + [*parts, *carried, "_bucket"]
    return summed.join(starts, [*key, "_bucket"]).withColumns(out).drop(*scratch)


def ema_columns_bounded(df: DataFrame, key: Sequence[str], specs: Mapping[str, tuple[str, float]]) -> DataFrame:
    """``ema_columns`` for keys that may be windowed whole, as with one row per trading day: no row is joined or shuffled.

    The ends of the buckets before a row, a few at most, are gathered along the key and chained by the same rule.
    """
    size = min(BLOCK_ROWS, *[_span(a) for _, a in specs.values()])
    along = Window.partitionBy(*key).orderBy(_POS)
    inside = Window.partitionBy(*key, "_bucket").orderBy(_POS).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto, before = along.rowsBetween(Window.unboundedPreceding, Window.currentRow), along.rowsBetween(Window.unboundedPreceding, -1)
    bucketed = df.withColumn("_bucket", F.expr(f"{_POS} div {size}"))
    values = sorted({value for value, _ in specs.values()})
    counted = bucketed.withColumns({f"_n_{v}": F.count(v).over(inside) for v in values})
    parts = {}
    for name, (value, alpha) in specs.items():
        n, decay = F.col(f"_n_{value}"), F.lit(1.0 - alpha)
        parts[f"_s_{name}"] = F.coalesce(F.sum(alpha * F.col(value) * F.pow(decay, -n)).over(inside) * F.pow(decay, n), F.lit(0.0))
    # Positions have no gaps: a bucket that has a successor ends at its last place.
    end = F.when(F.col(_POS) % size == size - 1, F.struct(*[f"_n_{v}" for v in values], *parts))
    chained = counted.withColumns(parts).withColumn("_ends", F.collect_list(end).over(before)).withColumns(
        {f"_f_{v}": F.first(v, ignorenulls=True).over(upto) for v in values})

    def average(name: str, value: str, alpha: float) -> Column:
        decay, seed = F.lit(1.0 - alpha), F.col(f"_f_{value}").cast("double")
        start = F.aggregate("_ends", seed, lambda y, e: y * F.pow(decay, e[f"_n_{value}"]) + e[f"_s_{name}"])
        return F.when(seed.isNotNull(), F.col(f"_s_{name}") + F.pow(decay, F.col(f"_n_{value}")) * start)

    out = {name: average(name, value, alpha) for name, (value, alpha) in specs.items()}
    return chained.withColumns(out).drop("_bucket", "_ends", *parts, *[f"_n_{v}" for v in values], *[f"_f_{v}" for v in values])


def running_totals(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    totals: Mapping[str, Column],
    within: Sequence[str] = (),
    number: bool = False,
) -> DataFrame:
    """Running sums from the start of each (key, within) to the current row, in two levels.

    Only the rows of one bucket meet in a task; the sums of earlier buckets are added from one small
    row per bucket. ``number`` also adds ``_pos``, the position inside ``key``, from the same pass. Like ``bucket``, the
    columns of ``within`` don't decrease in ``order``.
    """
    group = [*key, *within, "_bucket"]
    tagged = df.withColumn("_bucket", bucket)
    sums = tagged.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_s_{n}") for n, c in totals.items()]
    )

    def before(scope: Sequence[str], column: str) -> Column:
        # A bucket may lie across two parts of ``within``; these follow each other in time.
        w = Window.partitionBy(*scope).orderBy("_bucket", *within).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum(column).over(w), F.lit(0))

    base = sums.select(
        *group, before(key, "_n").alias("_base"),
        *[before([*key, *within], f"_s_{n}").alias(f"_b_{n}") for n in totals],
    )
    inner = Window.partitionBy(*group).orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {n: F.col(f"_b_{n}") + F.coalesce(F.sum(c).over(upto), F.lit(0)) for n, c in totals.items()}
    if number:
        added[_POS] = F.col("_base") + F.row_number().over(inner) - 1
    return tagged.join(base, group).withColumns(added).drop("_bucket", "_base", *[f"_b_{n}" for n in totals])
