"""Joins against dimensions: key resolution, membership, star joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.functions.cleanse import clean_symbol, date_key, normalise_symbols, require_columns
from candlewright.schemas import SUMMARY_METRICS

BROADCAST_BYTES = 10 * 1024 * 1024
SALTS = 16


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimised plan."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def hot_keys(facts: DataFrame, on: Sequence[str], share: float, most: int = 64) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the facts; a sketch of bounded size finds them in one pass.

    Runs a job that reads the key columns. Equal hashes of different keys do no harm: both count as hot.
    """
    top = facts.agg(F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), {most}, {64 * most})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in top["top"] or [] if r["count"] >= share * top["n"]]


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts to a lookup with unique keys, however the keys of the facts are distributed.

    A lookup whose estimated size is under ``broadcast_bytes`` is broadcast. For a larger one the keys that hold more
    than their task's share of the facts are found first (``hot_keys``); their rows spread over ``SALTS`` tasks and their
    rows of the lookup are copied as often. All other rows of the lookup stay single; without a hot key the join is plain.
    """
    on = list(on)
    if estimated_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), on, how)
    partitions = int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot_keys(facts, on, 1 / max(2, partitions))
    if not hot:
        return facts.join(lookup, on, how)
    kinds = {c: facts.schema[c].dataType for c in on}
    own, theirs = F.xxhash64(*on), F.xxhash64(*[F.col(c).cast(t) for c, t in kinds.items()])
    # The input partition joins the hash, so that equal copies of one row spread as well.
    mixed = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in facts.columns])
    salt = F.when(own.isin(hot), F.pmod(mixed, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salts = F.when(theirs.isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return facts.withColumn("_salt", salt).join(lookup.withColumn("_salt", F.explode(salts)), [*on, "_salt"], how).drop("_salt")


def unique_lookup(dim: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """One surrogate per natural key; the smallest where the dimension repeats itself."""
    require_columns(dim, [natural, surrogate], "dimension")
    return dim.where(F.col(natural).isNotNull()).groupBy(natural).agg(F.min(surrogate).alias(surrogate))


def join_summary(bars: DataFrame, summary: DataFrame, ranged: bool = False) -> DataFrame:
    """Bars with the fundamentals of the same symbol and day where there are any.

    Both lie in one frame that is shuffled once, by symbol: what is windowed by symbol afterwards isn't shuffled again.
    A symbol is bounded by the calendar on both sides. Of several fundamentals of a day the last ingested counts, as in ``one_per_key``.
    With ``ranged`` the tasks hold ranges of symbols: what is written from them by months needs no other shuffle.
    """
    present = [m for m in SUMMARY_METRICS if m in summary.columns]
    order = [c for c in ("ingested_at",) if c in summary.columns] + present
    known = F.col("symbol").isNotNull() & F.col("trade_date").isNotNull()
    joined = bars.repartitionByRange("symbol") if ranged and not present else bars
    if present:
        figures = summary.where(known).select(
            *[F.col(c).cast(bars.schema[c].dataType).alias(c) for c in ("symbol", "trade_date")], F.struct(*order).alias("_figures"), F.lit(False).alias("_bar"))
        both = bars.withColumn("_bar", F.lit(True)).unionByName(figures, allowMissingColumns=True)
        both = both.repartitionByRange("symbol") if ranged else both.repartition("symbol")
        best = F.when(known, F.max("_figures").over(Window.partitionBy("symbol", "trade_date")))
        rest = [c for c in bars.columns if c not in ("symbol", "trade_date")]
        joined = both.withColumn("_best", best).where("_bar").select("symbol", "trade_date", *rest, *[F.col(f"_best.{m}").alias(m) for m in present])
    for metric in SUMMARY_METRICS:
        if metric not in present:
            joined = joined.withColumn(metric, F.lit(None).cast("double"))
    return joined


def join_new_columns(left: DataFrame, right: DataFrame, on: Sequence[str] = ("symbol",)) -> DataFrame:
    """Left join that takes from the right only columns the left does not have."""
    extra = [c for c in right.columns if c not in left.columns]
    return left.join(right.select(*on, *extra), list(on), "left")


def resolve_fact_keys(
    facts: DataFrame,
    dim: DataFrame,
    surrogate: str,
    natural: str = "symbol",
    dim_natural: str | None = None,
    date_column: str = "trade_date",
    date_name: str = "date_key",
    on_orphan: str = "drop",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace the natural key and date of a fact by surrogate keys.

    Facts without a dimension row are dropped, or kept with a null key (``on_orphan="keep"``).
    """
    source = dim_natural or natural
    lookup = unique_lookup(dim, source, surrogate).withColumnRenamed(source, natural)
    joined = lookup_join(facts, lookup, [natural], "left", broadcast_bytes)
    if on_orphan == "drop":
        joined = joined.where(F.col(surrogate).isNotNull())
    measures = [c for c in facts.columns if c not in (natural, date_column, surrogate, date_name)]
    return joined.select(surrogate, date_key(date_column).alias(date_name), *measures)


def orphan_report(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None) -> DataFrame:
    """Fact keys without a dimension row and the number of their rows."""
    known = dim.select(F.col(dim_key or key).alias(key)).distinct()
    counted = facts.groupBy(key).agg(F.count(F.lit(1)).alias("fact_rows"))
    return counted.join(known, key, "left_anti")


def orphan_sample(facts: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, n: int = 10) -> DataFrame:
    return orphan_report(facts, dim, key, dim_key).orderBy(F.col(key).asc_nulls_last()).limit(n)


def resolve_bridge(bridge: DataFrame, dim_stock: DataFrame, dim_index: DataFrame) -> DataFrame:
    """Memberships with both surrogate keys; rows missing either are dropped."""
    require_columns(dim_stock, ["symbol", "stock_key"], "stock dimension")
    require_columns(dim_index, ["index_key"], "index dimension")
    named = bridge.withColumnRenamed("index_id", "index_key") if "index_key" not in bridge.columns else bridge
    keyed = lookup_join(named, unique_lookup(dim_stock, "symbol", "stock_key"), ["symbol"], "inner")
    indices = dim_index.select(F.col("index_key").cast("bigint").alias("index_key")).distinct()
    known = lookup_join(keyed, indices, ["index_key"], "inner")
    return known.select("stock_key", "index_key", "effective_from", "effective_to", "is_current")


def membership_snapshot(
    listing: DataFrame,
    indices: DataFrame,
    members: DataFrame,
    composite: str = "VNINDEX",
    targets: Sequence[str] | None = None,
) -> DataFrame:
    """Current (symbol, index_id) pairs.

    The composite index holds every listed symbol; the others hold the listed symbols among their
    members. ``members`` has (index_symbol, symbol).
    """
    listed = normalise_symbols(listing)
    info = indices.select(
        F.col("index_id").try_cast("bigint").alias("index_id"), clean_symbol("symbol").alias("index_symbol")
    ).where(F.col("index_id").isNotNull() & F.col("index_symbol").isNotNull()).distinct()
    if targets is not None:
        info = info.where(F.col("index_symbol").isin(*[t.upper() for t in targets]))
    named = members.select(
        clean_symbol("index_symbol").alias("index_symbol"), clean_symbol("symbol").alias("symbol")
    ).where((F.col("index_symbol") != composite) & F.col("symbol").isNotNull())
    everywhere = listed.withColumn("index_symbol", F.lit(composite))
    pairs = named.join(listed, "symbol", "left_semi").select("symbol", "index_symbol").unionByName(everywhere)
    return lookup_join(pairs, info, ["index_symbol"], "inner").select("symbol", "index_id").distinct()


def star_join(
    facts: DataFrame,
    dims: Sequence[tuple[DataFrame, str]],
    signals: DataFrame | None = None,
    signal_keys: Sequence[str] = (),
) -> DataFrame:
    """Fact joined to each (dimension, key), with optional signals of the same keys."""
    out = facts
    for dim, key in dims:
        out = lookup_join(out, dim, [key], "inner")
    return out if signals is None else out.join(signals, list(signal_keys), "left")
