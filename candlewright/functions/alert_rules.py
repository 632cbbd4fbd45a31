"""Alert rules over candles that carry vwap, sigma, rsi_14 and volume_ratio."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.functions.text import fixed
from candlewright.schemas import ALERT_COLUMNS


@dataclass(frozen=True)
class AlertConfig:
    """Default thresholds of the alert rules."""

    band_mode: str = "sigma"
    sigma_k: float = 2.0
    threshold_pct: float = 1.5
    rsi_period: int = 14
    rsi_overbought: float = 70.0
    rsi_oversold: float = 30.0
    rsi_extreme_high: float = 85.0
    rsi_extreme_low: float = 15.0
    volume_lookback: int = 20
    volume_spike: float = 3.0
    volume_extreme: float = 5.0
    cooldown_seconds: int = 300
    buffer_size: int = 50
    session_open: str = "09:00:00"
    session_close: str = "14:45:00"


def deviation_pct(price: Column, vwap: Column) -> Column:
    return F.when(vwap > 0, F.try_divide(price - vwap, vwap) * 100).otherwise(0.0)


def band_state(cfg: AlertConfig) -> Column:
    """BREAKOUT, BREAKDOWN or IN_BAND from price, vwap and sigma."""
    price, vwap, sigma = F.col("close"), F.col("vwap"), F.col("sigma")
    if cfg.band_mode == "pct":
        moved = deviation_pct(price, vwap)
        up, down, known = moved > cfg.threshold_pct, moved < -cfg.threshold_pct, vwap > 0
    else:
        up = price > vwap + cfg.sigma_k * sigma
        down = price < vwap - cfg.sigma_k * sigma
        known = (vwap > 0) & (sigma > 0)
    return F.when(known & up, "BREAKOUT").when(known & down, "BREAKDOWN").otherwise("IN_BAND")


@dataclass(frozen=True)
class Rule:
    """The alert type of a candle (null: silent) and the alert it then makes.

    The type becomes a column of its own before the alert is built from it, which keeps the
    expressions small. Types may refer to ``_band``, the state of the band.
    """

    name: str
    kind: Column
    fields: Callable[[Column], dict[str, Column]]

    def alert(self, kind: Column) -> Column:
        known = {
            "alert_time": F.col("candle_time"), "symbol": F.col("symbol"), "rule_name": F.lit(self.name),
            "alert_type": kind, "price": F.col("close"), **self.fields(kind),
        }
        return F.when(kind.isNotNull(), F.struct(*[known[c].alias(c) for c in ALERT_COLUMNS]))


def evaluate_rules(df: DataFrame, rules: Sequence[Callable[[AlertConfig], Rule]], cfg: AlertConfig) -> DataFrame:
    """Alerts of all rules over candles with indicators, in one pass."""
    made = [rule(cfg) for rule in rules]
    kinds = df.withColumn("_band", band_state(cfg)).withColumns({f"_kind_{i}": m.kind for i, m in enumerate(made)})
    some = F.coalesce(*[F.col(f"_kind_{i}") for i in range(len(made))]).isNotNull()
    alerts = F.array(*[m.alert(F.col(f"_kind_{i}")) for i, m in enumerate(made)])
    return kinds.where(some).select(F.explode(alerts).alias("_alert")).where("_alert IS NOT NULL").select("_alert.*")


def vwap_rule(cfg: AlertConfig) -> Rule:
    """Price outside the band around the session vwap."""
    state = F.col("_band")
    up = state == "BREAKOUT"
    price, vwap, sigma = F.col("close"), F.col("vwap"), F.col("sigma")
    moved = deviation_pct(price, vwap)
    symbol = F.col("symbol")
    # Message texts, here and in the rules below.
    if cfg.band_mode == "pct":
        threshold = F.lit(cfg.threshold_pct)
        message = F.when(up, F.concat(symbol, F.lit(" breakout ↑ VWAP +"), fixed(moved, 1), F.lit("%"))).otherwise(
            F.concat(symbol, F.lit(" breakdown ↓ VWAP "), fixed(moved, 1), F.lit("%"))
        )
    else:
        k = float(cfg.sigma_k)
        threshold = F.when(up, vwap + k * sigma).otherwise(vwap - k * sigma)
        message = F.when(
            up,
            F.concat(symbol, F.lit(f" vượt VWAP +{k}σ (giá "), fixed(price, 2), F.lit(" > band "), fixed(vwap + k * sigma, 2), F.lit(")")),
        ).otherwise(
            F.concat(symbol, F.lit(f" dưới VWAP -{k}σ (giá "), fixed(price, 2), F.lit(" < band "), fixed(vwap - k * sigma, 2), F.lit(")"))
        )
    kind = F.when(state == "BREAKOUT", "VWAP_BREAKOUT_UP").when(state == "BREAKDOWN", "VWAP_BREAKDOWN")
    return Rule("VWAP", kind, lambda kind: dict(
        severity=F.lit("WARNING"), indicator_value=vwap, threshold=threshold, deviation_pct=moved, message=message,
    ))


def rsi_rule(cfg: AlertConfig) -> Rule:
    """Relative strength beyond its thresholds; the extremes are critical."""
    rsi = F.col("rsi_14")
    high = rsi >= cfg.rsi_overbought
    extreme = (high & (rsi >= cfg.rsi_extreme_high)) | (~high & (rsi <= cfg.rsi_extreme_low))
    note = F.when(extreme, " (cực đoan!)").otherwise("")
    side = F.when(high, " — quá mua").otherwise(" — quá bán")
    kind = F.when(rsi >= cfg.rsi_overbought, "RSI_OVERBOUGHT").when(rsi <= cfg.rsi_oversold, "RSI_OVERSOLD")
    return Rule("RSI", kind, lambda kind: dict(
        severity=F.when(extreme, "CRITICAL").otherwise("WARNING"),
        indicator_value=rsi,
        threshold=F.when(high, F.lit(cfg.rsi_overbought)).otherwise(F.lit(cfg.rsi_oversold)),
        deviation_pct=F.lit(0.0),
        message=F.concat(F.col("symbol"), F.lit(" RSI="), fixed(rsi, 1), side, note),
    ))


def volume_rule(cfg: AlertConfig) -> Rule:
    """Volume far above the mean of the previous bars."""
    ratio = F.col("volume_ratio")
    extreme = ratio >= cfg.volume_extreme
    note = F.when(extreme, " (cực đoan!)").otherwise("")
    return Rule("VOLUME_SPIKE", F.when(ratio >= cfg.volume_spike, "VOLUME_SPIKE"), lambda kind: dict(
        severity=F.when(extreme, "CRITICAL").otherwise("WARNING"),
        indicator_value=ratio,
        threshold=F.lit(cfg.volume_spike),
        deviation_pct=F.lit(0.0),
        message=F.concat(F.col("symbol"), F.lit(" KL đột biến "), fixed(ratio, 1), F.lit("x trung bình"), note),
    ))


def combined_type(state: Column, rsi: Column, ratio: Column, cfg: AlertConfig) -> Column:
    """Alert type where at least two of band, strength and volume agree, else null."""
    up, down = state == "BREAKOUT", state == "BREAKDOWN"
    hot = F.coalesce(rsi >= cfg.rsi_overbought, F.lit(False))
    cold = F.coalesce(rsi <= cfg.rsi_oversold, F.lit(False))
    spike = F.coalesce(ratio >= cfg.volume_spike, F.lit(False))
    with_spike = (
        F.when(up & hot, "COMBINED_PUMP_RISK")
        .when(down & cold, "COMBINED_PANIC_SELL")
        .when(up, "COMBINED_VOLUME_BREAKOUT")
        .when(down, "COMBINED_VOLUME_BREAKDOWN")
        .otherwise("COMBINED_UNUSUAL_VOLUME")
    )
    return (
        F.when(spike, with_spike)
        .when(up & hot, "COMBINED_OVERBOUGHT_BREAKOUT")
        .when(down & cold, "COMBINED_OVERSOLD_BREAKDOWN")
    )


def combined_severity(kind: Column) -> Column:
    return F.when(kind.isin("COMBINED_PUMP_RISK", "COMBINED_PANIC_SELL"), "CRITICAL").otherwise("WARNING")


def combined_message(kind: Column, symbol: Column, rsi: Column, ratio: Column) -> Column:
    strength = F.when((rsi.isNull()) | (rsi == 0), F.lit("?")).otherwise(fixed(rsi, 0))
    plain = fixed(rsi, 0)
    times = F.concat(fixed(ratio, 1), F.lit("x"))
    # Message texts.
    texts = {
        "COMBINED_PUMP_RISK": (" ⚠️ RỦI RO ĐẨY GIÁ — Breakout VWAP + RSI=", plain, " (quá mua) + KL ", times),
        "COMBINED_PANIC_SELL": (" 🔴 BÁN THÁO — Breakdown VWAP + RSI=", plain, " (quá bán) + KL ", times),
        "COMBINED_OVERBOUGHT_BREAKOUT": (" Breakout VWAP + RSI=", plain, " (quá mua) — cẩn trọng"),
        "COMBINED_OVERSOLD_BREAKDOWN": (" Breakdown VWAP + RSI=", plain, " (quá bán) — có thể là cơ hội"),
        "COMBINED_UNUSUAL_VOLUME": (" 🟠 KL đột biến ", times, " — RSI=", strength, ", giá trong band VWAP"),
        "COMBINED_VOLUME_BREAKOUT": (" Breakout ↑ VWAP + KL ", times, " — RSI=", strength),
        "COMBINED_VOLUME_BREAKDOWN": (" Breakdown ↓ VWAP + KL ", times, " — RSI=", strength),
    }
    out = None
    for name, parts in texts.items():
        text = F.concat(symbol, *[F.lit(p) if isinstance(p, str) else p for p in parts])
        out = F.when(kind == name, text) if out is None else out.when(kind == name, text)
    return out


def combined_fields(kind: Column, rsi: Column, ratio: Column, price: Column, vwap: Column, cfg: AlertConfig) -> dict[str, Column]:
    """Severity, indicator, threshold, deviation and message of a combined alert."""
    by_volume = kind.isin("COMBINED_UNUSUAL_VOLUME", "COMBINED_VOLUME_BREAKOUT", "COMBINED_VOLUME_BREAKDOWN")
    high = kind.isin("COMBINED_PUMP_RISK", "COMBINED_OVERBOUGHT_BREAKOUT")
    return dict(
        severity=combined_severity(kind),
        indicator_value=F.when(by_volume, ratio).otherwise(rsi),
        threshold=F.when(by_volume, F.lit(cfg.volume_spike))
        .when(high, F.lit(cfg.rsi_overbought)).otherwise(F.lit(cfg.rsi_oversold)),
        deviation_pct=deviation_pct(price, vwap),
        message=combined_message(kind, F.col("symbol"), rsi, ratio),
    )


def combined_rule(cfg: AlertConfig) -> Rule:
    """The ordered matrix of band state, strength and volume."""
    rsi, ratio = F.col("rsi_14"), F.col("volume_ratio")
    kind = combined_type(F.col("_band"), rsi, ratio, cfg)
    return Rule("COMBINED", kind, lambda kind: combined_fields(kind, rsi, ratio, F.col("close"), F.col("vwap"), cfg))


def legacy_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts of the vwap rule in the shape of the older table."""
    return alerts.where(F.col("rule_name") == "VWAP").select(
        "alert_time", "symbol", F.replace(F.col("alert_type"), F.lit("VWAP_"), F.lit("")).alias("alert_type"),
        "price", F.col("indicator_value").alias("vwap"), "deviation_pct",
    )


def critical_feed(alerts: DataFrame) -> DataFrame:
    return alerts.where(F.col("severity") == "CRITICAL")
