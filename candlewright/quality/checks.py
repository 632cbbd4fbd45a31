"""Declarative data-quality checks.

A check compiles to a ``Measure``: a few aggregates and a verdict over them. Measures that read the
rows themselves share one aggregate pass over the frame; measures over value counts share one
``groupBy(keys).count()`` per key list, whose map-side part keeps a hot value small. Nothing but one
row per check reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.operators.quantiles import exact_quantiles

Config = dict[str, Any]
Judge = Callable[[Callable[[str], Column]], dict[str, Column]]


@dataclass
class Measure:
    column: str
    aggregates: dict[str, Column]
    judge: Judge
    keys: tuple[str, ...] | None = None  # value counts of these columns
    source: DataFrame | None = None  # another reduced frame
    bad: Column | None = field(default=None)  # predicate of unexpected rows
    rows: Callable[[DataFrame], DataFrame] | None = None  # unexpected rows, where no predicate of a row finds them


def need(config: Config, *keys: str) -> list[Any]:
    missing = [k for k in keys if config.get(k) is None or config.get(k) == "" or config.get(k) == []]
    if missing:
        raise KeyError(f"missing required keys {missing}")
    return [config[k] for k in keys]


def present(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} do not exist; the frame has {df.columns}")


def within(value: Column, config: Config) -> Column:
    """min_value/max_value with strict_min/strict_max; at least one bound is needed."""
    low, high = config.get("min_value"), config.get("max_value")
    if low is None and high is None:
        raise KeyError("one of 'min_value' and 'max_value' is required")
    ok = value.isNotNull()
    if low is not None:
        ok = ok & ((value > low) if config.get("strict_min") else (value >= low))
    if high is not None:
        ok = ok & ((value < high) if config.get("strict_max") else (value <= high))
    return F.coalesce(ok, F.lit(False))


def verdict(success: Column, n: Column, unexpected: Column | None = None, observed: Column | None = None,
            considered: Column | None = None) -> dict[str, Column]:
    return {
        "success": success,
        "element_count": n.cast("bigint"),
        "unexpected_count": F.lit(None).cast("bigint") if unexpected is None else unexpected.cast("bigint"),
        "unexpected_percent": F.lit(None).cast("double") if unexpected is None
        else F.coalesce(F.try_divide(unexpected * 100.0, n if considered is None else considered), F.lit(0.0)),
        "observed_value": F.lit(None).cast("double") if observed is None else observed.cast("double"),
    }


def rows_measure(column: str, bad: Column, ignored: Column | None = None, mostly: float = 1.0) -> Measure:
    """Every row not ignored must pass, or the share ``mostly`` of them."""
    skip = F.lit(False) if ignored is None else ignored
    wrong = ~skip & F.coalesce(bad, F.lit(True))

    def judge(get):
        considered, unexpected = get("n") - get("skipped"), get("bad")
        ok = considered - unexpected >= considered * F.lit(float(mostly))
        return verdict(ok, get("n"), unexpected, considered=considered)

    aggregates = {"n": F.count(F.lit(1)), "skipped": F.count_if(skip), "bad": F.count_if(wrong)}
    return Measure(column, aggregates, judge, bad=wrong)


def values_measure(df: DataFrame, config: Config, bad: Callable[[Column], Column]) -> list[Measure]:
    (column,) = need(config, "column")
    present(df, column)
    c = F.col(column)
    return [rows_measure(column, bad(c), c.isNull(), config.get("mostly", 1.0))]


def statistic(df: DataFrame, config: Config, aggregate: Callable[[Column], Column]) -> list[Measure]:
    (column,) = need(config, "column")
    present(df, column)
    return [Measure(
        column, {"n": F.count(F.lit(1)), "v": aggregate(F.col(column))},
        lambda get: verdict(within(get("v"), config), get("n"), observed=get("v")),
    )]


def fact(column: str, success: bool, observed: float | None = None) -> list[Measure]:
    """A verdict that follows from the schema alone; it rides on the row count."""
    return [Measure(column, {"n": F.count(F.lit(1))}, lambda get: verdict(
        F.lit(bool(success)), get("n"), observed=None if observed is None else F.lit(float(observed))))]


def counts_measure(
    df: DataFrame, config: Config, aggregates: Callable[[Column], dict[str, Column]], judge: Judge, rows: Callable[[DataFrame], DataFrame] | None = None
) -> list[Measure]:
    """Over value counts: rows (value, _n), the null value included."""
    (column,) = need(config, "column")
    present(df, column)
    return [Measure(column, {"n": F.sum("_n"), **aggregates(F.col(column))}, judge, keys=(column,), rows=rows)]


# completeness ---------------------------------------------------------------------------------

def column_not_null(df, config):
    (column,) = need(config, "column")
    present(df, column)
    return [rows_measure(column, F.col(column).isNull(), mostly=config.get("mostly", 1.0))]


def columns_not_null(df, config):
    (columns,) = need(config, "columns")
    present(df, *columns)
    return [rows_measure(c, F.col(c).isNull(), mostly=config.get("mostly", 1.0)) for c in columns]


def column_be_null(df, config):
    (column,) = need(config, "column")
    present(df, column)
    return [rows_measure(column, F.col(column).isNotNull())]


def columns_be_null(df, config):
    (columns,) = need(config, "columns")
    present(df, *columns)
    return [rows_measure(c, F.col(c).isNotNull()) for c in columns]


def column_non_null_proportion_between(df, config):
    column, _, _ = need(config, "column", "min_value", "max_value")
    present(df, column)

    def judge(get):
        share = F.try_divide(get("v").cast("double"), get("n"))
        return verdict(within(share, config), get("n"), observed=share)

    return [Measure(column, {"n": F.count(F.lit(1)), "v": F.count(column)}, judge)]


def row_has_at_least_one_non_null(df, config):
    (columns,) = need(config, "columns")
    present(df, *columns)
    empty = F.lit(True)
    for c in columns:
        empty = empty & F.col(c).isNull()
    return [rows_measure(",".join(columns), empty)]


# consistency ----------------------------------------------------------------------------------

def column_a_greater_than_b(df, config):
    a, b = need(config, "column_a", "column_b")
    present(df, a, b)
    x, y = F.col(a), F.col(b)
    ok = x >= y if config.get("or_equal", True) else x > y
    return [rows_measure(f"{a},{b}", ~ok, x.isNull() & y.isNull())]


def multicolumn_sum_to_equal(df, config):
    columns, total = need(config, "column_list", "sum_total")
    present(df, *columns)
    value, empty = F.lit(0.0), F.lit(True)
    for c in columns:
        value, empty = value + F.col(c), empty & F.col(c).isNull()
    return [rows_measure(",".join(columns), value != F.lit(total), empty)]


def group_consistency(df, config):
    """Every group holds one value, a null counting as a value of its own."""
    group, value = need(config, "group_col", "value_col")
    present(df, group, value)
    per_group = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_filled"),
        (F.min(value) != F.max(value)).alias("_differ"),
    )
    mixed = F.coalesce(F.col("_differ"), F.lit(False)) | ((F.col("_filled") > 0) & (F.col("_filled") < F.col("_n")))
    return [Measure(
        f"{group},{value}",
        {"n": F.sum("_n"), "bad": F.coalesce(F.sum(F.when(mixed, F.col("_n"))), F.lit(0)), "groups": F.count_if(mixed)},
        lambda get: verdict(get("groups") == 0, get("n"), get("bad"), get("groups")), source=per_group,
        rows=lambda rows: inconsistent_rows(rows, group, value),
    )]


def inconsistent_rows(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows of the groups that hold more than one value."""
    per_group = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"), F.count(value).alias("_filled"),
        (F.min(value) != F.max(value)).alias("_differ"),
    )
    mixed = per_group.where(
        F.coalesce(F.col("_differ"), F.lit(False)) | ((F.col("_filled") > 0) & (F.col("_filled") < F.col("_n")))
    ).select(F.col(group).alias("_group"))
    return df.join(mixed, F.col(group).eqNullSafe(F.col("_group")), "left_semi")


# ranges and statistics ------------------------------------------------------------------------

def column_datetime_range(df, config):
    column, start, end = need(config, "column", "start_time", "end_time")
    present(df, column)
    dtype = df.schema[column].dataType
    bounds = {"min_value": F.lit(start).cast(dtype), "max_value": F.lit(end).cast(dtype),
              "strict_min": config.get("strict_start"), "strict_max": config.get("strict_end")}
    return values_measure(df, config, lambda c: ~within(c, bounds))


def column_values_between(df, config):
    return values_measure(df, config, lambda c: ~within(c, config))


def column_max_between(df, config):
    return statistic(df, config, F.max)


def column_min_between(df, config):
    return statistic(df, config, F.min)


def column_mean_between(df, config):
    return statistic(df, config, F.avg)


def column_stdev_to_be_between(df, config):
    return statistic(df, config, F.stddev_samp)


def column_sum_to_be_between(df, config):
    return statistic(df, config, F.sum)


def column_median_between(df, config):
    (column,) = need(config, "column")
    present(df, column)
    source = exact_quantiles(df, [], column, [0.5], ["v"])
    return [Measure(
        column, {"v": F.max("v"), "n": F.max(df.agg(F.count(F.lit(1))).scalar())},
        lambda get: verdict(within(get("v"), config), get("n"), observed=get("v")), source=source,
    )]


def column_quantile_values_to_be_between(df, config):
    column, ranges = need(config, "column", "quantile_ranges")
    present(df, column)
    probs, bounds = ranges["quantiles"], ranges["value_ranges"]
    if len(probs) != len(bounds):
        raise ValueError("quantiles and value_ranges differ in length")
    names = [f"q{i}" for i in range(len(probs))]
    method = config.get("allow_relative_error") or "nearest"
    source = exact_quantiles(df, [], column, probs, names, method)

    def judge(get):
        ok = F.lit(True)
        for name, (low, high) in zip(names, bounds):
            if low is not None or high is not None:
                ok = ok & within(get(name), {"min_value": low, "max_value": high})
        return verdict(ok, get("n"), observed=get(names[0]))

    return [Measure(column, {"n": F.max(df.agg(F.count(F.lit(1))).scalar()), **{n: F.max(n) for n in names}}, judge, source=source)]


def column_kl_divergence_less_than(df, config):
    """Divergence of the observed shares from the expected ones; an unexpected value is infinite."""
    column, partition, threshold = need(config, "column", "partition_object", "threshold")
    present(df, column)
    values, weights = partition["values"], partition["weights"]
    if len(values) != len(weights) or not math.isclose(sum(weights), 1.0, abs_tol=1e-6):
        raise ValueError("values and weights must pair up and the weights sum to 1")
    weight = F.lit(None).cast("double")
    for v, w in zip(values, weights):
        weight = F.when(F.col(column) == F.lit(v), F.lit(float(w))).otherwise(weight)
    known = F.col(column).isNotNull()
    log_share = F.when(weight > 0, F.ln(F.col("_n") / weight))

    def judge(get):
        kl = F.when(get("outside") > 0, F.lit(float("inf"))).otherwise(get("s") / get("filled") - F.ln(get("filled")))
        return verdict(F.coalesce(kl < float(threshold), F.lit(False)), get("n"), observed=kl)

    return counts_measure(df, config, lambda c: {
        "filled": F.sum(F.when(known, F.col("_n"))),
        "outside": F.count_if(known & ~F.coalesce(weight > 0, F.lit(False))),
        "s": F.sum(F.when(known, F.col("_n") * log_share)),
    }, judge)


def column_value_zscores_to_be_less_than(df, config):
    column, threshold = need(config, "column", "threshold")
    present(df, column)
    c = F.col(column)
    # Both moments from one pass over the column; the second pass counts.
    moments = df.agg(F.struct(F.avg(column).alias("mean"), F.stddev_samp(column).alias("spread"))).scalar()
    z = F.try_divide(c - moments["mean"], moments["spread"])
    size = F.abs(z) if config.get("double_sided", True) else z
    bad = ~(size < F.lit(float(threshold)))
    measure = rows_measure(column, F.col("_bad"), F.col("_null"), config.get("mostly", 1.0))
    measure.source, measure.bad = df.select(c.isNull().alias("_null"), bad.alias("_bad")), c.isNotNull() & F.coalesce(bad, F.lit(True))
    return [measure]


# schema ---------------------------------------------------------------------------------------

def columns_to_match_set(df, config):
    (expected,) = need(config, "column_set")
    actual, wanted = set(df.columns), set(expected)
    ok = actual == wanted if config.get("exact_match", True) else wanted <= actual
    return fact(",".join(sorted(wanted)), ok, len(df.columns))


def columns_to_match_ordered_list(df, config):
    (expected,) = need(config, "column_list")
    return fact(",".join(expected), df.columns == list(expected), len(df.columns))


def table_column_count_equal(df, config):
    (value,) = need(config, "value")
    return fact("*", len(df.columns) == value, len(df.columns))


def table_column_count_between(df, config):
    low, high = config.get("min_value"), config.get("max_value")
    if low is None and high is None:
        raise KeyError("one of 'min_value' and 'max_value' is required")
    n = len(df.columns)
    return fact("*", (low is None or n >= low) and (high is None or n <= high), n)


def type_names(df: DataFrame, column: str) -> set[str]:
    """Names a column's type goes by, e.g. double and DoubleType."""
    dtype = df.schema[column].dataType
    return {dtype.simpleString(), dtype.typeName(), type(dtype).__name__}


def column_values_to_be_in_type_list(df, config):
    column, types = need(config, "column", "type_list")
    present(df, column)
    return fact(column, bool(type_names(df, column) & set(types)))


def column_values_to_be_of_type(df, config):
    column, expected = need(config, "column", "expected_type")
    present(df, column)
    return fact(column, expected in type_names(df, column))


def column_to_exist(df, config):
    (column,) = need(config, "column")
    return fact(column, column in df.columns)


# sets and texts -------------------------------------------------------------------------------

def column_values_in_set(df, config):
    (values,) = need(config, "value_set")
    return values_measure(df, config, lambda c: ~c.isin(*values))


def column_values_not_in_set(df, config):
    (values,) = need(config, "value_set")
    return values_measure(df, config, lambda c: c.isin(*values))


def column_most_common_value_in_set(df, config):
    """The most frequent values; with ties_okay one of them in the set is enough."""
    column, values = need(config, "column", "value_set")
    present(df, column)
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    top = F.col("_n") == counts.agg(F.max("_n")).scalar()
    source = counts.withColumns({"_top": top, "_in": F.col(column).isin(*values)})
    ties = bool(config.get("ties_okay", False))

    def judge(get):
        ok = get("hits") > 0 if ties else (get("modes") == 1) & (get("hits") == 1)
        return verdict(ok, get("n"), observed=get("modes"))

    return [Measure(column, {
        "n": F.max(df.agg(F.count(F.lit(1))).scalar()), "modes": F.count_if("_top"), "hits": F.count_if(F.col("_top") & F.col("_in")),
    }, judge, source=source)]


def column_value_lengths_to_equal(df, config):
    (value,) = need(config, "value")
    return values_measure(df, config, lambda c: F.length(c) != value)


def column_value_lengths_between(df, config):
    return values_measure(df, config, lambda c: ~within(F.length(c), config))


def column_pair_values_in_set(df, config):
    a, b, pairs = need(config, "column_a", "column_b", "value_pairs_set")
    present(df, a, b)
    allowed = F.lit(False)
    for x, y in pairs:
        allowed = allowed | (F.col(a).eqNullSafe(F.lit(x)) & F.col(b).eqNullSafe(F.lit(y)))
    return [rows_measure(f"{a},{b}", ~allowed, F.col(a).isNull() & F.col(b).isNull())]


def _missing(columns: Sequence[str], mode: str) -> Column:
    flags = [F.col(c).isNull() for c in columns]
    if mode in ("never", "neither"):
        return F.lit(False)
    any_mode = mode in ("either_value_is_missing", "any_value_is_missing")
    if not any_mode and mode not in ("both_values_are_missing", "all_values_are_missing"):
        raise ValueError(f"unknown ignore_row_if {mode!r}")
    out = flags[0]
    for f in flags[1:]:
        out = out | f if any_mode else out & f
    return out


def column_pair_values_equal(df, config):
    a, b = need(config, "column_a", "column_b")
    present(df, a, b)
    ignored = _missing([a, b], config.get("ignore_row_if", "both_values_are_missing"))
    return [rows_measure(f"{a},{b}", ~F.col(a).eqNullSafe(F.col(b)), ignored)]


def column_values_match_regex(df, config):
    (regex,) = need(config, "regex")
    return values_measure(df, config, lambda c: ~c.rlike(regex))


def column_values_not_match_regex(df, config):
    (regex,) = need(config, "regex")
    return values_measure(df, config, lambda c: c.rlike(regex))


def _matches(tests: Sequence[Column], mode: str) -> Column:
    if mode not in ("any", "all"):
        raise ValueError(f"match_on must be any or all, not {mode!r}")
    out = tests[0]
    for t in tests[1:]:
        out = out | t if mode == "any" else out & t
    return out


def column_values_match_regex_list(df, config):
    (patterns,) = need(config, "regex_list")
    return values_measure(df, config, lambda c: ~_matches([c.rlike(p) for p in patterns], config.get("match_on", "any")))


def column_values_not_match_regex_list(df, config):
    (patterns,) = need(config, "regex_list")
    return values_measure(df, config, lambda c: _matches([c.rlike(p) for p in patterns], "any"))


def column_values_match_like_list(df, config):
    (patterns,) = need(config, "like_pattern_list")
    return values_measure(df, config, lambda c: ~_matches([c.like(p) for p in patterns], config.get("match_on", "any")))


# uniqueness -----------------------------------------------------------------------------------

def column_values_unique(df, config):
    return counts_measure(
        df, config,
        lambda c: {"filled": F.coalesce(F.sum(F.when(c.isNotNull(), F.col("_n"))), F.lit(0)),
                   "bad": F.coalesce(F.sum(F.when(c.isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0))},
        lambda get: verdict(get("bad") == 0, get("n"), get("bad"), considered=get("filled")),
        lambda rows: repeated_rows(rows.where(F.col(config["column"]).isNotNull()), [config["column"]]),
    )


def compound_columns_unique(df, config):
    (columns,) = need(config, "column_list")
    present(df, *columns)
    skip = _missing(columns, config.get("ignore_row_if", "never"))
    return [Measure(
        ",".join(columns),
        {"n": F.sum("_n"), "bad": F.coalesce(F.sum(F.when((F.col("_n") > 1) & ~skip, F.col("_n"))), F.lit(0))},
        lambda get: verdict(get("bad") == 0, get("n"), get("bad")), keys=tuple(columns), rows=lambda rows: repeated_rows(rows.where(~skip), columns),
    )]


def repeated_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once."""
    twice = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    renamed = {c: f"_k{i}" for i, c in enumerate(columns)}
    condition = F.lit(True)
    for c, k in renamed.items():
        condition = condition & F.col(c).eqNullSafe(F.col(k))
    return df.join(twice.drop("_n").withColumnsRenamed(renamed), condition, "left_semi")


def _distinct_sets(df, config, ok, rows=None):
    (values,) = need(config, "value_set")
    wanted = list(dict.fromkeys(values))

    def judge(get):
        outside, missing = get("outside"), F.lit(len(wanted)) - get("inside")
        return verdict(ok(outside, missing), get("n"), observed=get("outside") + get("inside"))

    return counts_measure(df, config, lambda c: {
        "inside": F.count_if(c.isNotNull() & c.isin(*wanted)), "outside": F.count_if(c.isNotNull() & ~c.isin(*wanted)),
    }, judge, rows)


def _outside(config):
    return lambda rows: rows.where(F.col(config["column"]).isNotNull() & ~F.col(config["column"]).isin(*config["value_set"]))


def column_distinct_values_in_set(df, config):
    return _distinct_sets(df, config, lambda outside, missing: outside == 0, _outside(config))


def column_distinct_values_to_equal_set(df, config):
    return _distinct_sets(df, config, lambda outside, missing: (outside == 0) & (missing == 0), _outside(config))


def column_distinct_values_contain_set(df, config):
    return _distinct_sets(df, config, lambda outside, missing: missing == 0)


def select_column_values_unique_within_record(df, config):
    (columns,) = need(config, "column_list")
    present(df, *columns)
    kinds = F.size(F.array_distinct(F.array(*[F.col(c).cast("string") for c in columns])))
    ignored = _missing(columns, config.get("ignore_row_if", "all_values_are_missing"))
    return [rows_measure(",".join(columns), kinds < len(columns), ignored)]


def column_unique_value_count_to_be_between(df, config):
    return counts_measure(
        df, config, lambda c: {"v": F.count_if(c.isNotNull())},
        lambda get: verdict(within(get("v"), config), get("n"), observed=get("v")),
    )


def column_proportion_of_unique_values_to_be_between(df, config):
    def judge(get):
        share = F.try_divide(get("v").cast("double"), get("filled"))
        return verdict(within(share, config), get("n"), observed=share)

    return counts_measure(df, config, lambda c: {
        "v": F.count_if(c.isNotNull()), "filled": F.sum(F.when(c.isNotNull(), F.col("_n"))),
    }, judge)


# volume ---------------------------------------------------------------------------------------

def table_row_count_between(df, config):
    within(F.lit(0), config)
    return [Measure("*", {"n": F.count(F.lit(1))}, lambda get: verdict(within(get("n"), config), get("n"), observed=get("n")))]


def table_row_count_to_equal(df, config):
    (value,) = need(config, "value")
    return [Measure("*", {"n": F.count(F.lit(1))}, lambda get: verdict(get("n") == value, get("n"), observed=get("n")))]


CHECKS: dict[str, Callable[[DataFrame, Config], list[Measure]]] = {
    f.__name__: f
    for f in (
        column_not_null, columns_not_null, column_be_null, columns_be_null,
        column_non_null_proportion_between, row_has_at_least_one_non_null,
        column_a_greater_than_b, multicolumn_sum_to_equal, group_consistency,
        column_datetime_range, column_values_between, column_max_between, column_min_between,
        column_mean_between, column_median_between, column_kl_divergence_less_than,
        column_quantile_values_to_be_between, column_stdev_to_be_between, column_sum_to_be_between,
        column_value_zscores_to_be_less_than,
        columns_to_match_set, columns_to_match_ordered_list, table_column_count_equal,
        column_values_to_be_in_type_list, column_values_to_be_of_type, column_to_exist,
        table_column_count_between,
        column_values_in_set, column_most_common_value_in_set, column_value_lengths_to_equal,
        column_value_lengths_between, column_pair_values_in_set, column_pair_values_equal,
        column_values_match_regex, column_values_match_regex_list, column_values_match_like_list,
        column_values_not_in_set, column_values_not_match_regex, column_values_not_match_regex_list,
        column_values_unique, compound_columns_unique, column_distinct_values_in_set,
        column_distinct_values_to_equal_set, column_distinct_values_contain_set,
        select_column_values_unique_within_record, column_unique_value_count_to_be_between,
        column_proportion_of_unique_values_to_be_between,
        table_row_count_between, table_row_count_to_equal,
    )
}
