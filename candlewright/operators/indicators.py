"""Technical indicators over daily bars and over intraday candles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from candlewright.functions.text import round_exact
from candlewright.operators.series import (
    BLOCK_ROWS,
    block_window,
    blocks,
    drop_halo,
    ema_columns,
    ema_columns_bounded,
    positions,
    running_totals,
    time_bounds,
    with_range,
)

WILDER = 1.0 / 14
SPAN_12 = 2.0 / 13
SPAN_26 = 2.0 / 27


def change_pct(close: Column, previous: Column) -> Column:
    return F.try_divide(close, previous) - 1


def simple_average(value: str, n: int, w: WindowSpec) -> Column:
    """Mean of the last n values; null until n of them are present."""
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(value).over(frame) == n, F.avg(value).over(frame))


def rsi_from_averages(gain: Column, loss: Column) -> Column:
    return F.when(loss == 0, F.lit(100.0)).otherwise(
        100.0 - F.try_divide(F.lit(100.0), 1.0 + F.try_divide(gain, loss))
    )


def typical_price() -> Column:
    return (F.col("high") + F.col("low") + F.col("close")) / 3.0


def daily_indicators(bars: DataFrame, include_vwap: bool = True) -> DataFrame:
    """All indicators of the daily tables.

    ``bars`` holds one row per (symbol, trade_date), so a symbol is bounded by the calendar and may be windowed whole.
    """
    key = ["symbol"]
    w = Window.partitionBy(*key).orderBy("trade_date")
    previous = F.lag("close").over(w)
    stepped = positions(bars, key, ["trade_date"]).withColumns({
        "price_change_pct": change_pct(F.col("close"), previous),
        "_delta": F.col("close") - previous,
        "sma_20": simple_average("close", 20, w),
        "sma_50": simple_average("close", 50, w),
    }).withColumns({
        "_gain": F.greatest(F.col("_delta"), F.when(F.col("_delta").isNotNull(), F.lit(0.0))),
        "_loss": F.greatest(-F.col("_delta"), F.when(F.col("_delta").isNotNull(), F.lit(0.0))),
    })
    smoothed = ema_columns_bounded(stepped, key, {
        "ema_12": ("close", SPAN_12),
        "ema_26": ("close", SPAN_26),
        "_avg_gain": ("_gain", WILDER),
        "_avg_loss": ("_loss", WILDER),
    })
    out = smoothed.withColumns({
        "macd": F.col("ema_12") - F.col("ema_26"),
        "rsi_14": rsi_from_averages(F.col("_avg_gain"), F.col("_avg_loss")),
    })
    if include_vwap:
        out = out.withColumn("vwap", typical_price())
    return out.drop("_pos", "_delta", "_gain", "_loss", "_avg_gain", "_avg_loss").withColumnRenamed("volume", "total_volume")


def candle_positions(candles: DataFrame, key: Sequence[str] = ("symbol",), bounds: Sequence[float] | None = None) -> DataFrame:
    """Candles numbered within their symbol. ``bounds``: see ``time_bounds``, which runs a job if they aren't given."""
    order = ["candle_time"] + (["received_at"] if "received_at" in candles.columns else [])
    ranged = with_range(candles, "candle_time", time_bounds(candles, "candle_time") if bounds is None else bounds)
    return positions(ranged, key, order, F.col("_range")).drop("_range")


def rsi_simple(w: WindowSpec, delta: str = "_delta", period: int = 14) -> Column:
    """RSI over plain means of the last ``period`` deltas, not yet rounded."""
    frame = w.rowsBetween(-(period - 1), 0)
    gain = F.sum(F.greatest(F.col(delta), F.lit(0.0))).over(frame) / period
    loss = F.sum(F.greatest(-F.col(delta), F.lit(0.0))).over(frame) / period
    value = F.when(loss == 0, F.lit(100.0)).when(gain == 0, F.lit(0.0)).otherwise(
        100.0 - 100.0 / (1.0 + F.try_divide(gain, loss))
    )
    return F.when(F.count(delta).over(frame) == period, value)


def rsi_rolling(w: WindowSpec, delta: str = "_delta", period: int = 14) -> Column:
    """Chart variant: a missing first delta counts as 0, no value where the loss is 0."""
    frame = w.rowsBetween(-(period - 1), 0)
    step = F.coalesce(F.col(delta), F.lit(0.0))
    gain = F.avg(F.greatest(step, F.lit(0.0))).over(frame)
    loss = F.avg(F.greatest(-step, F.lit(0.0))).over(frame)
    value = 100.0 - F.try_divide(F.lit(100.0), 1.0 + F.try_divide(gain, F.when(loss != 0, loss)))
    return F.when(F.count(F.lit(1)).over(frame) == period, value)


def volume_ratio(w: WindowSpec, lookback: int = 20) -> Column:
    """Volume against the mean of the previous ``lookback`` bars, not yet rounded."""
    frame = w.rowsBetween(-lookback, -1)
    mean = F.avg("volume").over(frame)
    return F.when(
        (F.count("volume").over(frame) == lookback) & (mean > 0),
        F.try_divide(F.col("volume").cast("double"), mean),
    )


def volume_ratio_lenient(w: WindowSpec, lookback: int = 20) -> Column:
    """As above with whatever earlier bars exist; the mean counts as 1 when there is none."""
    mean = F.coalesce(F.avg("volume").over(w.rowsBetween(-lookback, -1)), F.lit(1.0))
    return F.when(mean > 0, F.try_divide(F.col("volume").cast("double"), mean)).otherwise(0.0)


def candle_indicators(candles: DataFrame, period: int = 14, lookback: int = 20) -> DataFrame:
    """rsi_14, rsi_chart, volume_ratio, volume_ratio_lenient, volume_avg_20 and volume_spike.

    ``candles`` holds one row per (symbol, candle_time), numbered already if it carries ``_pos``;
    a hot symbol is spread over its blocks, which overlap by the longest frame. ``rsi_14`` keeps its name
    whatever the period.
    """
    halo = max(period + 1, lookback, 20)
    numbered = candles if "_pos" in candles.columns else candle_positions(candles)
    cut = blocks(numbered, halo, max(BLOCK_ROWS, 8 * halo))
    w = block_window(["symbol"])
    stepped = cut.withColumn("_delta", F.col("close") - F.lag("close").over(w))
    out = stepped.withColumns({
        "_rsi": rsi_simple(w, period=period),
        "_ratio": volume_ratio(w, lookback),
        "rsi_chart": rsi_rolling(w, period=period),
        "volume_ratio_lenient": volume_ratio_lenient(w, lookback),
        "volume_avg_20": simple_average("volume", 20, w),
    })
    return drop_halo(out).withColumns({
        "rsi_14": round_exact(F.col("_rsi"), 2),
        "volume_ratio": round_exact(F.col("_ratio"), 2),
        "volume_spike": F.coalesce(F.col("volume") >= F.col("volume_avg_20") * 3.0, F.lit(False)),
    }).drop("_delta", "_rsi", "_ratio")


def candle_rsi_seeded(candles: DataFrame, period: int = 14) -> DataFrame:
    """Add rsi_seeded: Wilder smoothing whose first average is the plain mean of ``period`` deltas."""
    alpha = 1.0 / period
    cut = blocks(candle_positions(candles), period + 1, max(BLOCK_ROWS, 8 * period))
    w = block_window(["symbol"])
    frame = w.rowsBetween(-(period - 1), 0)
    stepped = cut.withColumn("_delta", F.col("close") - F.lag("close").over(w))
    up, down = F.greatest(F.col("_delta"), F.lit(0.0)), F.greatest(-F.col("_delta"), F.lit(0.0))
    pos = F.col("_pos")
    seeded = stepped.withColumns({
        name: F.when(F.col("_delta").isNotNull(), F.when(pos == period, F.avg(step).over(frame)).when(pos > period, step))
        for name, step in (("_gain", up), ("_loss", down))
    })
    smoothed = ema_columns(
        drop_halo(seeded, keep_positions=True), ["symbol"], {"_avg_gain": ("_gain", alpha), "_avg_loss": ("_loss", alpha)}
    )
    out = smoothed.withColumn("rsi_seeded", F.when(pos >= period, rsi_from_averages(F.col("_avg_gain"), F.col("_avg_loss"))))
    return out.drop("_pos", "_delta", "_gain", "_loss", "_avg_gain", "_avg_loss")


def session_vwap(
    candles: DataFrame,
    session_only: bool = False,
    open_time: str = "09:00:00",
    close_time: str = "14:45:00",
    number: bool = False,
    bounds: Sequence[float] | None = None,
) -> DataFrame:
    """Running volume-weighted price and deviation per (symbol, local day).

    ``bounds``: see ``time_bounds``, which runs a job if they aren't given. With ``session_only`` rows outside the trading hours keep their place but add nothing; before
    the first row of the session the result is null.
    """
    clock = F.date_format("candle_time", "HH:mm:ss.SSSSSS")
    inside = clock.between(f"{open_time}.000000", f"{close_time}.000000") if session_only else F.lit(True)
    volume = F.when(inside, F.col("volume")).otherwise(0).cast("double")
    price = typical_price()
    order = ["candle_time"] + (["received_at"] if "received_at" in candles.columns else [])
    ranged = with_range(candles, "candle_time", time_bounds(candles, "candle_time") if bounds is None else bounds)
    summed = running_totals(
        ranged.withColumn("session_date", F.to_date("candle_time")), ["symbol"], order, F.col("_range"),
        {"_v": volume, "_pv": price * volume, "_p2v": price * price * volume},
        within=["session_date"], number=number,
    ).drop("_range")
    vwap = F.when(F.col("_v") > 0, F.try_divide(F.col("_pv"), F.col("_v")))
    spread = F.try_divide(F.col("_p2v"), F.col("_v"))
    return (
        summed.withColumn("vwap", vwap)
        .withColumn("sigma", F.when(F.col("_v") > 0, F.sqrt(F.greatest(spread - vwap * vwap, F.lit(0.0)))))
        .drop("_v", "_pv", "_p2v")
    )


def sigma_bands(df: DataFrame, k: float = 2.0) -> DataFrame:
    width = k * F.coalesce(F.col("sigma"), F.lit(0.0))
    return df.withColumns({"upper_band": F.col("vwap") + width, "lower_band": F.col("vwap") - width})


def intraday_view(
    candles: DataFrame,
    symbol: str,
    day: str,
    start_time: str = "09:00:00",
    limit: int = 300,
    latest_only: bool = False,
    session_only: bool = False,
) -> DataFrame:
    """Candles of one symbol and day with running vwap and sigma, newest ``limit``, oldest first.

    The start time cuts after the running sums, so earlier candles still count in them.
    """
    from candlewright.operators.bars import latest_revisions

    day_rows = candles.where((F.col("symbol") == symbol) & (F.to_date("candle_time") == F.lit(day).cast("date")))
    if latest_only:
        day_rows = latest_revisions(day_rows)
    shown = session_vwap(day_rows, session_only).where(F.date_format("candle_time", "HH:mm:ss") >= start_time)
    newest = shown.orderBy(F.col("candle_time").desc()).limit(limit)
    return newest.select(
        F.col("candle_time").alias("time"), "open", "high", "low",
        F.col("close").alias("price"), F.col("volume").alias("quantity"), "vwap", "sigma",
    ).orderBy("time")
