"""The whole alert path over stored candles, in batch."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from candlewright.functions.alert_rules import AlertConfig, Rule, combined_rule, evaluate_rules
from candlewright.operators.bars import latest_revisions
from candlewright.operators.cooldown import apply_cooldown
from candlewright.operators.indicators import candle_indicators, session_vwap
from candlewright.operators.series import time_bounds


def enrich_candles(candles: DataFrame, cfg: AlertConfig = AlertConfig()) -> DataFrame:
    """Final revisions with session vwap, sigma, rsi_14 and volume_ratio."""
    latest = latest_revisions(candles)
    # The times of all revisions cut as well as those of the last ones, and need no aggregation.
    summed = session_vwap(latest, True, cfg.session_open, cfg.session_close, number=True, bounds=time_bounds(candles, "candle_time"))
    return candle_indicators(summed, cfg.rsi_period, cfg.volume_lookback)


def replay_alerts(
    candles: DataFrame,
    cfg: AlertConfig = AlertConfig(),
    rules: Sequence[Callable[[AlertConfig], Rule]] = (combined_rule,),
) -> DataFrame:
    """Alerts that would have fired, had each candle arrived once in its final revision."""
    found = evaluate_rules(enrich_candles(candles, cfg), rules, cfg)
    return apply_cooldown(found, cfg.cooldown_seconds)
