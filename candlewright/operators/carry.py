"""Daily indicators that go on from stored state, so that a new day doesn't need the history of its symbols.

The state of a symbol after a bar is the end value of each recursive average and the last ``TAIL`` bars. Going on is the
same calculation as from the start: the bars of the tail are put before the new ones, for the frames that look back, and
the averages begin with the stored end value in the place of a first value, which is what a recursive average starts from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewright.operators.indicators import SPAN_12, SPAN_26, WILDER, change_pct, rsi_from_averages, simple_average, typical_price
from candlewright.operators.series import ema_columns_bounded, positions

TAIL = 50
AVERAGES = {"ema_12": SPAN_12, "ema_26": SPAN_26, "avg_gain": WILDER, "avg_loss": WILDER}
STATE = "symbol string, trade_date date, " + ", ".join(f"{a} double" for a in AVERAGES) + ", tail array<struct<trade_date:date,close:double>>"


def month_of(column: str | Column) -> Column:
    return F.date_format(column, "yyyy-MM")


def continued_indicators(bars: DataFrame, state: DataFrame | None = None, include_vwap: bool = True) -> DataFrame:
    """``daily_indicators`` of ``bars``, with avg_gain, avg_loss and macd_prev, going on from ``state`` where a symbol has one.

    All bars of a symbol must be later than its state. One row per (symbol, trade_date).
    """
    rows = bars.withColumn("_new", F.lit(True))
    if state is not None:
        last = F.col("_i") == F.size("tail") - 1
        old = state.select("symbol", *AVERAGES, "tail", F.posexplode("tail").alias("_i", "_b")).select(
            "symbol", F.col("_b.trade_date").alias("trade_date"), F.col("_b.close").alias("close"), F.lit(False).alias("_new"),
            *[F.when(last, F.col(a)).alias(f"_from_{a}") for a in AVERAGES],
        )
        # A symbol that is silent from here on has no part in the work.
        rows = rows.unionByName(old.join(bars.select("symbol").distinct(), "symbol", "left_semi"), allowMissingColumns=True)
    else:
        rows = rows.withColumns({f"_from_{a}": F.lit(None).cast("double") for a in AVERAGES})
    w = Window.partitionBy("symbol").orderBy("trade_date")
    previous = F.lag("close").over(w)
    stepped = positions(rows, ["symbol"], ["trade_date"]).withColumns({
        "price_change_pct": change_pct(F.col("close"), previous), "_delta": F.col("close") - previous,
        "sma_20": simple_average("close", 20, w), "sma_50": simple_average("close", 50, w),
    })
    zero = F.when(F.col("_delta").isNotNull(), F.lit(0.0))
    steps = {"ema_12": F.col("close"), "ema_26": F.col("close"), "avg_gain": F.greatest(F.col("_delta"), zero), "avg_loss": F.greatest(-F.col("_delta"), zero)}
    fed = stepped.withColumns({f"_x_{a}": F.when(F.col("_new"), x).otherwise(F.col(f"_from_{a}")) for a, x in steps.items()})
    smoothed = ema_columns_bounded(fed, ["symbol"], {a: (f"_x_{a}", alpha) for a, alpha in AVERAGES.items()})
    out = smoothed.withColumns({
        "macd": F.col("ema_12") - F.col("ema_26"), "rsi_14": rsi_from_averages(F.col("avg_gain"), F.col("avg_loss")),
    }).withColumn("macd_prev", F.lag("macd").over(w)).where("_new")
    if include_vwap:
        out = out.withColumn("vwap", typical_price())
    scratch = ["_pos", "_delta", "_new", *[f"_x_{a}" for a in AVERAGES], *[f"_from_{a}" for a in AVERAGES]]
    return out.drop(*scratch).withColumnRenamed("volume", "total_volume")


def states(rows: DataFrame, state: DataFrame | None, months: Sequence[str]) -> DataFrame:
    """(state_month, state) of every symbol at the end of each of ``months``, also where it had no bar in that month.

    ``rows`` are from ``continued_indicators`` and go on from ``state``. A symbol has one row per month with bars here; a tail
    is put together from at most ``TAIL`` of them, since each holds a bar or more.
    """
    bar, averages = F.struct("trade_date", "close"), F.struct("trade_date", *AVERAGES)
    own = rows.groupBy("symbol", month_of("trade_date").alias("_month")).agg(
        F.max_by(averages, "trade_date").alias("_end"), F.sort_array(F.collect_list(bar)).alias("_bars")
    )
    if state is not None:
        own = own.unionByName(state.select("symbol", F.lit("").alias("_month"), averages.alias("_end"), F.col("tail").alias("_bars")))
    along = Window.partitionBy("symbol").orderBy("_month")
    known = own.withColumns({
        "_tail": F.flatten(F.collect_list("_bars").over(along.rowsBetween(-(TAIL - 1), 0))), "_until": F.lead("_month").over(along),
    })
    marks = F.filter(F.array(*map(F.lit, months)), lambda m: (m >= F.col("_month")) & (F.col("_until").isNull() | (m < F.col("_until"))))
    tail = F.slice("_tail", F.greatest(F.size("_tail") - (TAIL - 1), F.lit(1)), TAIL).alias("tail")
    return known.select(F.explode(marks).alias("state_month"), "symbol", "_end.*", tail)


def kept_months(months: Sequence[str], recent: int = 13) -> list[str]:
    """Months whose state is worth keeping: the last ``recent`` and every December before."""
    ordered = sorted(months)
    return [m for i, m in enumerate(ordered) if i >= len(ordered) - recent or m.endswith("-12")]
