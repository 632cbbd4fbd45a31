"""Continuous alerts over a candle stream.

State is kept per symbol: the last candles and, for the newest local day and the one before it, the contribution of
every candle to the session sums, so that a candle sent again replaces what it added before, also when it comes
after midnight. Each alert type remembers when it last fired. The state of a symbol that falls silent expires.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from candlewright.functions.alert_rules import (
    AlertConfig,
    Rule,
    band_state,
    combined_rule,
    critical_feed,
    legacy_alerts,
)
from candlewright.schemas import ALERT_COLUMNS

_OUTPUT = """alert_time timestamp, symbol string, rule_name string, alert_type string, price double, vwap double,
sigma double, rsi double, ratio double"""
_STATE = """days array<string>, sum_v array<double>, sum_pv array<double>, sum_p2v array<double>,
part_days array<string>, times array<bigint>, prices array<double>, volumes array<double>,
candle_times array<bigint>, closes array<double>, candle_volumes array<double>,
kinds array<string>, fired array<bigint>"""


def rsi_of(closes: list[float], period: int) -> float | None:
    """Strength over plain means of the last ``period`` steps."""
    if len(closes) < period + 1:
        return None
    steps = [b - a for a, b in zip(closes[-period - 1:], closes[-period:])]
    gain = sum(s for s in steps if s > 0) / period
    loss = sum(-s for s in steps if s < 0) / period
    if loss == 0:
        return 100.0
    return 0.0 if gain == 0 else round(100.0 - 100.0 / (1.0 + gain / loss), 2)


def ratio_of(volumes: list[float], lookback: int) -> float | None:
    if len(volumes) < lookback + 1:
        return None
    mean = sum(volumes[-lookback - 1:-1]) / lookback
    return round(volumes[-1] / mean, 2) if mean > 0 else None


def band_side(price, vwap, sigma, cfg: AlertConfig) -> int:
    """1 above the band, -1 below, else 0; the column form is ``band_state``."""
    if not vwap or vwap <= 0:
        return 0
    if cfg.band_mode == "pct":
        moved = (price - vwap) / vwap * 100
        return (moved > cfg.threshold_pct) - (moved < -cfg.threshold_pct)
    if not sigma or sigma <= 0:
        return 0
    return (price > vwap + cfg.sigma_k * sigma) - (price < vwap - cfg.sigma_k * sigma)


def combined_kind(side: int, rsi, ratio, cfg: AlertConfig) -> str | None:
    """The combined rule for one candle; the column form is ``combined_type``."""
    strong = rsi is not None and (
        (side > 0 and rsi >= cfg.rsi_overbought) or (side < 0 and rsi <= cfg.rsi_oversold)
    )
    if ratio is not None and ratio >= cfg.volume_spike:
        names = {0: "UNUSUAL_VOLUME", 1: "PUMP_RISK" if strong else "VOLUME_BREAKOUT",
                 -1: "PANIC_SELL" if strong else "VOLUME_BREAKDOWN"}
        return "COMBINED_" + names[side]
    if strong:
        return "COMBINED_OVERBOUGHT_BREAKOUT" if side > 0 else "COMBINED_OVERSOLD_BREAKDOWN"
    return None


def rsi_kind(rsi, cfg: AlertConfig) -> str | None:
    if rsi is None:
        return None
    return "RSI_OVERBOUGHT" if rsi >= cfg.rsi_overbought else "RSI_OVERSOLD" if rsi <= cfg.rsi_oversold else None


def kinds_of(names: Sequence[str], price, vwap, sigma, rsi, ratio, cfg: AlertConfig) -> list[tuple[str, str]]:
    """(rule, alert type) of the named rules that speak up for one candle."""
    side = band_side(price, vwap, sigma, cfg)
    found = {
        "VWAP": {1: "VWAP_BREAKOUT_UP", -1: "VWAP_BREAKDOWN"}.get(side), "RSI": rsi_kind(rsi, cfg),
        "VOLUME_SPIKE": "VOLUME_SPIKE" if ratio is not None and ratio >= cfg.volume_spike else None,
        "COMBINED": combined_kind(side, rsi, ratio, cfg),
    }
    return [(n, found[n]) for n in names if found[n] is not None]


DAYS_KEPT = 2
LATEST = "2 days"


class _Session:
    """The mutable form of one symbol's state."""

    def __init__(self, saved: tuple | None):
        s = saved or ([],) * 13
        self.sums = {d: [v, pv, p2v] for d, v, pv, p2v in zip(*s[:4])}
        self.parts: dict[str, dict[int, tuple[float, float]]] = {d: {} for d in self.sums}
        for d, t, p, q in zip(*s[4:8]):
            self.parts[d][t] = (p, q)
        self.candles = {t: (c, q) for t, c, q in zip(*s[8:11])}
        self.fired = dict(zip(*s[11:13]))

    def saved(self) -> tuple:
        days, candles, fired = sorted(self.sums), sorted(self.candles.items()), sorted(self.fired.items())
        parts = [(d, t, *self.parts[d][t]) for d in days for t in sorted(self.parts[d])]
        return (
            days, *[[float(self.sums[d][i]) for d in days] for i in range(3)],
            *[[p[i] for p in parts] for i in range(4)],
            [t for t, _ in candles], [c for _, (c, _) in candles], [q for _, (_, q) in candles],
            [k for k, _ in fired], [t for _, t in fired],
        )

    def add_to_session(self, t: int, day: str, price: float, volume: float) -> None:
        known = sorted({*self.sums, day})[-DAYS_KEPT:]
        if day not in known:  # its session has expired
            return
        for old in [d for d in self.sums if d not in known]:
            del self.sums[old], self.parts[old]
        sums, parts = self.sums.setdefault(day, [0.0, 0.0, 0.0]), self.parts.setdefault(day, {})
        old_price, old_volume = parts.get(t, (0.0, 0.0))
        for i in range(3):
            sums[i] += price**i * volume - old_price**i * old_volume
        parts[t] = (price, volume)

    def band(self, day: str) -> tuple[float | None, float | None]:
        v, pv, p2v = self.sums.get(day, (0.0, 0.0, 0.0))
        if v <= 0:
            return None, None
        vwap = pv / v
        return vwap, math.sqrt(max(p2v / v - vwap * vwap, 0.0))

    def push(self, t: int, close: float, volume: float, size: int) -> tuple[list[float], list[float]]:
        """Keep the last ``size`` candles; return closes and volumes up to time ``t``."""
        self.candles[t] = (close, volume)
        for old in sorted(self.candles)[:-size]:
            del self.candles[old]
        upto = [self.candles[k] for k in sorted(self.candles) if k <= t]
        return [c for c, _ in upto], [q for _, q in upto]


def _on_candles(cfg: AlertConfig, rules: Sequence[str], idle_hours: float):
    def step(key: tuple, frames: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        session = _Session(tuple(state.get) if state.exists else None)
        rows = pd.concat(list(frames), ignore_index=True)
        # The last revision of each candle in this batch, in candle order.
        rows = rows.sort_values(["t", "r"]).drop_duplicates("t", keep="last")
        out = []
        for row in rows.itertuples(index=False):
            if row.inside:
                session.add_to_session(row.t, row.day, row.typical, float(row.volume))
            closes, volumes = session.push(row.t, row.close, float(row.volume), cfg.buffer_size)
            if row.warm:
                continue
            vwap, sigma = session.band(row.day)
            rsi, ratio = rsi_of(closes, cfg.rsi_period), ratio_of(volumes, cfg.volume_lookback)
            for name, kind in kinds_of(rules, row.close, vwap, sigma, rsi, ratio, cfg):
                last = session.fired.get(kind)
                if last is None or row.t - last >= cfg.cooldown_seconds * 1_000_000:
                    session.fired[kind] = row.t
                    out.append((row.candle_time, key[0], name, kind, row.close, vwap, sigma, rsi, ratio))
        state.update(session.saved())
        silent = int(rows["t"].max()) // 1000 + int(idle_hours * 3_600_000)
        state.setTimeoutTimestamp(max(silent, state.getCurrentWatermarkMs() + 1))
        if out:
            figures = ["price", "vwap", "sigma", "rsi", "ratio"]
            frame = pd.DataFrame(out, columns=["alert_time", "symbol", "rule_name", "alert_type", *figures])
            yield frame.astype({c: "float64" for c in figures})

    return step


def _slim(candles: DataFrame, cfg: AlertConfig, warm: bool) -> DataFrame:
    clock = F.date_format("candle_time", "HH:mm:ss.SSSSSS")
    inside = clock.between(f"{cfg.session_open}.000000", f"{cfg.session_close}.000000")
    return candles.select(
        "symbol", "candle_time", F.unix_micros(F.col("candle_time").cast("timestamp")).alias("t"),
        F.unix_micros(F.col("received_at").cast("timestamp")).alias("r"),
        F.date_format("candle_time", "yyyy-MM-dd").alias("day"), inside.alias("inside"),
        ((F.col("high") + F.col("low") + F.col("close")) / 3.0).alias("typical"),
        F.col("close").cast("double").alias("close"), F.col("volume").cast("double").alias("volume"), F.lit(warm).alias("warm"),
    )


#: How far a candle may be ahead of the moment it was received; below ``LATEST``, so that none makes true candles late.
AHEAD = "1 day"


def is_ahead(tolerance: str = AHEAD) -> Column:
    """A candle dated later than it was received (or than now, where that isn't known), beyond the tolerance.

    One such candle would move the watermark of all symbols on, and their true candles would be late from then on.
    """
    received = F.coalesce(F.col("received_at").cast("timestamp"), F.current_timestamp())
    return F.coalesce(F.col("candle_time").cast("timestamp") > received + F.expr(f"interval {tolerance}"), F.lit(False))


def set_aside(candles: DataFrame, tolerance: str = AHEAD) -> DataFrame:
    """The candles that ``detect_alerts`` doesn't take because they are ahead of time, for a table of their own."""
    return candles.where(is_ahead(tolerance))


def detect_alerts(
    candles: DataFrame,
    cfg: AlertConfig = AlertConfig(),
    rules: Sequence[Callable[[AlertConfig], Rule]] = (combined_rule,),
    warm_up: DataFrame | None = None,
    idle_hours: float = 48.0,
    ahead: str = AHEAD,
) -> DataFrame:
    """Alerts of the given rules over a stream of (possibly revised) candles.

    Offsets in the checkpoint take the place of a high-water mark. ``warm_up`` is a stream over stored candles (the last
    day of the candle table, say): they fill sessions and buffers and raise nothing. Read it in one batch, so that it
    comes with, or before, the first new candles. A symbol without candles for ``idle_hours`` of candle time loses its
    state; candles older than ``LATEST`` before the newest of an earlier batch belong to expired sessions and are skipped.
    Candles ``ahead`` of the moment they were received are left out before the watermark sees them (``set_aside``).
    """
    slim = _slim(candles.where(~is_ahead(ahead)), cfg, False)
    if warm_up is not None:
        slim = slim.unionByName(_slim(warm_up.where(~is_ahead(ahead)), cfg, True))
    raised = slim.withWatermark("candle_time", LATEST).groupBy("symbol").applyInPandasWithState(
        _on_candles(cfg, [rule(cfg).name for rule in rules], idle_hours), _OUTPUT, _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return shape_alerts(raised, cfg, rules)


def shape_alerts(raised: DataFrame, cfg: AlertConfig, rules: Sequence[Callable[[AlertConfig], Rule]] = (combined_rule,)) -> DataFrame:
    """Raised alerts in the shape of the alert table, by the same expressions as in batch."""
    named = raised.withColumnsRenamed({"alert_time": "candle_time", "price": "close", "rsi": "rsi_14", "ratio": "volume_ratio"})
    made = [rule(cfg) for rule in rules]
    alert = F.coalesce(*[F.when(F.col("rule_name") == m.name, m.alert(F.col("alert_type"))) for m in made])
    return named.withColumn("_band", band_state(cfg)).select(alert.alias("_alert")).select(*[F.col(f"_alert.{c}").alias(c) for c in ALERT_COLUMNS])


def append_stream(df: DataFrame, path: str, checkpoint: str, partition_by: str | None = None):
    """Append a parsed stream to a table until all available input is read."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    return writer.trigger(availableNow=True).start(path)


def sink_alerts(alerts: DataFrame, root: str, checkpoint: str):
    """Write alerts, their legacy form and the critical feed, each batch exactly once.

    A batch overwrites its own ``batch_id`` partition, so one that is retried leaves no duplicates.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        tables = {"alerts_v2": batch, "alerts": legacy_alerts(batch), "critical": critical_feed(batch)}
        batch.persist()
        try:
            for name, rows in tables.items():
                rows.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
                    "partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/{name}")
        finally:
            batch.unpersist()

    return (
        alerts.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
