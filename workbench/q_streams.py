"""Alert rules, cooldown and replay over stored candles, and the same over streams."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import functions as F

from candlewright.functions import alert_rules as R
from candlewright.operators.cooldown import apply_cooldown
from candlewright.operators.replay import enrich_candles, replay_alerts
from candlewright.sources import stream as ST
from candlewright.streaming import detector
from workbench import mapping as M
from workbench import sqlparts as S
from workbench.catalog import nudge, query, r, rounded, rx
from workbench.stage import scratch

EAGER = R.AlertConfig(sigma_k=1.0, rsi_overbought=55.0, rsi_oversold=45.0, volume_spike=2.0)


def eager_alerts(spark, d):
    return replay_alerts(M.revised_candles(spark, d), EAGER)


def tidy(alerts):
    """Comparable columns: rounded figures, local wall time."""
    out = alerts.withColumn("alert_time", F.col("alert_time").cast("timestamp_ntz"))
    return rounded(out, 3, "indicator_value", "threshold", "deviation_pct")


ALERT_SQL = """SELECT candle_time AS alert_time, symbol, 'COMBINED' AS rule_name, alert_type,
 CASE WHEN alert_type IN ('COMBINED_PUMP_RISK', 'COMBINED_PANIC_SELL') THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
 close AS price,
 round(CASE WHEN alert_type IN ('COMBINED_UNUSUAL_VOLUME', 'COMBINED_VOLUME_BREAKOUT', 'COMBINED_VOLUME_BREAKDOWN') THEN volume_ratio ELSE rsi_14 END + {n}, 3) AS indicator_value,
 CASE WHEN alert_type IN ('COMBINED_UNUSUAL_VOLUME', 'COMBINED_VOLUME_BREAKOUT', 'COMBINED_VOLUME_BREAKDOWN') THEN {spike}
      WHEN alert_type IN ('COMBINED_PUMP_RISK', 'COMBINED_OVERBOUGHT_BREAKOUT') THEN {high} ELSE {low} END AS threshold,
 round(CASE WHEN vwap > 0 THEN (close - vwap) / vwap * 100 ELSE 0 END + {n}, 3) AS deviation_pct"""


def alert_sql(high, low, spike, source, where="true"):
    return ALERT_SQL.format(high=f"{high}::DOUBLE", low=f"{low}::DOUBLE", spike=f"{spike}::DOUBLE", n=f"{nudge(3)!r}::DOUBLE") + f" FROM {source} WHERE {where}"


@query("str_12_combined_rule", f"WITH {S.candidates(1, 55, 45, 2)} {alert_sql(55, 45, 2, 'candidates')}")
def _(spark, d):
    found = R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), EAGER), [R.combined_rule], EAGER)
    return tidy(found).drop("message")


@query("str_12_combined_messages", f"""WITH {S.candidates(1, 55, 45, 2)}
SELECT symbol, candle_time AS alert_time, alert_type FROM candidates""")
def _(spark, d):
    """Types whose message names the type's own texts; the texts themselves are pinned in the tests."""
    found = R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), EAGER), [R.combined_rule], EAGER)
    said = found.where(F.startswith("message", F.concat("symbol", F.lit(" "))))
    return said.select("symbol", "alert_time", "alert_type")


@query("str_16_replay_eager", f"WITH {S.candidates(1, 55, 45, 2)} {S.FIRED} {alert_sql(55, 45, 2, 'alerts')}")
def _(spark, d):
    return tidy(eager_alerts(spark, d)).drop("message")


@query("str_16_replay_default", f"WITH {S.candidates(2, 70, 30, 3)} {S.FIRED} {alert_sql(70, 30, 3, 'alerts')}")
def _(spark, d):
    return tidy(replay_alerts(M.revised_candles(spark, d))).drop("message")


@query("str_9_vwap_rule", f"""WITH {S.ENRICHED},
hits AS (SELECT *, CASE WHEN vwap > 0 AND sigma > 0 AND close > vwap + 2 * sigma THEN 'VWAP_BREAKOUT_UP'
  WHEN vwap > 0 AND sigma > 0 AND close < vwap - 2 * sigma THEN 'VWAP_BREAKDOWN' END AS alert_type FROM measured)
SELECT candle_time AS alert_time, symbol, 'VWAP' AS rule_name, alert_type, 'WARNING' AS severity, close AS price,
  {rx(3, 'vwap', 'indicator_value')}, {rx(3, "CASE WHEN alert_type = 'VWAP_BREAKDOWN' THEN vwap - 2 * sigma ELSE vwap + 2 * sigma END", 'threshold')},
  {rx(3, '(close - vwap) / vwap * 100', 'deviation_pct')} FROM hits WHERE alert_type IS NOT NULL""")
def _(spark, d):
    cfg = R.AlertConfig()
    return tidy(R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), cfg), [R.vwap_rule], cfg)).drop("message")


@query("str_9_vwap_rule_pct", f"""WITH {S.ENRICHED},
hits AS (SELECT *, (close - vwap) / vwap * 100 AS dev FROM measured WHERE vwap > 0)
SELECT candle_time AS alert_time, symbol, CASE WHEN dev > 1.5 THEN 'VWAP_BREAKOUT_UP' ELSE 'VWAP_BREAKDOWN' END AS alert_type,
  {rx(3, 'dev', 'deviation_pct')} FROM hits WHERE abs(dev) > 1.5""")
def _(spark, d):
    cfg = R.AlertConfig(band_mode="pct")
    found = tidy(R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), cfg), [R.vwap_rule], cfg))
    return found.select("alert_time", "symbol", "alert_type", "deviation_pct")


@query("str_10_rsi_rule", f"""WITH {S.ENRICHED}
SELECT candle_time AS alert_time, symbol, 'RSI' AS rule_name, CASE WHEN rsi_14 >= 70 THEN 'RSI_OVERBOUGHT' ELSE 'RSI_OVERSOLD' END AS alert_type,
  CASE WHEN rsi_14 >= 85 OR rsi_14 <= 15 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, close AS price,
  rsi_14 AS indicator_value, CASE WHEN rsi_14 >= 70 THEN 70.0::DOUBLE ELSE 30.0::DOUBLE END AS threshold, 0.0::DOUBLE AS deviation_pct
FROM measured WHERE rsi_14 >= 70 OR rsi_14 <= 30""")
def _(spark, d):
    cfg = R.AlertConfig()
    return tidy(R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), cfg), [R.rsi_rule], cfg)).drop("message")


@query("str_11_volume_rule", f"""WITH {S.ENRICHED}
SELECT candle_time AS alert_time, symbol, 'VOLUME_SPIKE' AS rule_name, 'VOLUME_SPIKE' AS alert_type,
  CASE WHEN volume_ratio >= 5 THEN 'CRITICAL' ELSE 'WARNING' END AS severity, close AS price,
  volume_ratio AS indicator_value, 3.0::DOUBLE AS threshold, 0.0::DOUBLE AS deviation_pct FROM measured WHERE volume_ratio >= 3""")
def _(spark, d):
    cfg = R.AlertConfig()
    return tidy(R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), cfg), [R.volume_rule], cfg)).drop("message")


@query("str_13_cooldown", f"""WITH {S.REVISED},
candidates AS MATERIALIZED (SELECT symbol, candle_time, CASE WHEN volume % 2 = 0 THEN 'EVEN' ELSE 'ODD' END AS alert_type FROM latest)
{S.FIRED} SELECT symbol, alert_type, candle_time AS alert_time FROM alerts""")
def _(spark, d):
    """Cooldown alone, with every candle a candidate: dense series that chain across hours."""
    from candlewright.operators.bars import latest_revisions

    every = latest_revisions(M.revised_candles(spark, d)).select(
        "symbol", F.when(F.col("volume") % 2 == 0, "EVEN").otherwise("ODD").alias("alert_type"),
        F.col("candle_time").alias("alert_time"),
    )
    return apply_cooldown(every, 300)


@query("str_14_legacy_alerts", f"""WITH {S.ENRICHED}
SELECT candle_time AS alert_time, symbol, CASE WHEN close > vwap + 2 * sigma THEN 'BREAKOUT_UP' ELSE 'BREAKDOWN' END AS alert_type,
  close AS price, {r(3, 'vwap')}, {rx(3, '(close - vwap) / vwap * 100', 'deviation_pct')}
FROM measured WHERE vwap > 0 AND sigma > 0 AND (close > vwap + 2 * sigma OR close < vwap - 2 * sigma)""")
def _(spark, d):
    cfg = R.AlertConfig()
    found = R.evaluate_rules(enrich_candles(M.revised_candles(spark, d), cfg), [R.vwap_rule, R.rsi_rule], cfg)
    return rounded(R.legacy_alerts(found), 3, "vwap", "deviation_pct")


@query("str_15_critical_feed", f"WITH {S.candidates(1, 55, 45, 2)} {S.FIRED} " + alert_sql(
    55, 45, 2, "alerts", "alert_type IN ('COMBINED_PUMP_RISK', 'COMBINED_PANIC_SELL')"))
def _(spark, d):
    return tidy(R.critical_feed(eager_alerts(spark, d))).drop("message")


# messages and streams -------------------------------------------------------------------------

def candle_messages(spark, d, revised=False):
    """Candles as JSON messages; the clock of a message counts whole seconds."""
    rows = M.revised_candles(spark, d) if revised else M.candles(spark, d)
    return rows.select(
        "candle_time", F.to_json(F.struct(
            F.date_format("received_at", "yyyy-MM-dd'T'HH:mm:ss.SSS").alias("received_at"), "symbol",
            F.lit("1").alias("resolution"), "open", "high", "low", "close", "volume", F.lit("STOCK").alias("type"),
            F.unix_seconds(F.col("candle_time").cast("timestamp")).alias("time"),
            F.unix_seconds(F.col("received_at").cast("timestamp")).alias("lastUpdated"),
        )).alias("value"))


def broken(messages):
    """A few messages cut short in place of their whole text."""
    return messages.unionByName(messages.where("value like '%\"volume\":7,%'").withColumn("value", F.expr("substr(value, 1, 40)")))


PARSED = f"""WITH {S.CANDLES}
SELECT date_trunc('millisecond', received_at) AS received_at, date_trunc('second', candle_time) AS candle_time, symbol, '1' AS resolution, 'STOCK' AS market_type,
  open, high, low, close, volume, CAST(epoch(date_trunc('second', received_at)) AS BIGINT) AS "lastUpdated" FROM candles"""


def ntz(df, *columns):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


@query("src_6_candle_messages", PARSED)
def _(spark, d):
    parsed = ST.candle_stream(broken(candle_messages(spark, d)).select("value"))
    return ntz(parsed, "received_at", "candle_time")


TRADES = """SELECT date_trunc('millisecond', ts) AS received_at, event_type AS symbol, value AS price,
 CAST(event_id % 100 AS BIGINT) AS quantity, CAST(event_id AS BIGINT) AS total_volume, CAST(event_id % 7 AS SMALLINT) AS board_id,
 CAST(user_id % 3 AS SMALLINT) AS market_id FROM events"""


def trade_messages(spark, d):
    return M.table(spark, d, "events").select(F.to_json(F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS").alias("received_at"), F.col("event_type").alias("symbol"),
        F.col("value").alias("price"), (F.col("event_id") % 100).alias("quantity"), F.col("event_id").alias("total_volume"),
        (F.col("event_id") % 7).alias("board_id"), (F.col("user_id") % 3).alias("market_id"))).alias("value"))


@query("src_7_trade_messages", TRADES)
def _(spark, d):
    messages = trade_messages(spark, d)
    cut = messages.where("value like '%\"quantity\":5,%'").withColumn("value", F.lit('{"symbol":'))
    return ntz(ST.trade_stream(messages.unionByName(cut)), "received_at")


def land(spark, messages, parts=3):
    """Write messages as text files of successive time ranges, one after the other; returns the folder.

    The file source takes files in the order of their age, as they would arrive.
    """
    path = scratch(spark, "landing", uuid4().hex)
    day = F.dayofmonth("candle_time")
    for i in range(parts):
        last = i == parts - 1
        slice_ = messages.where((day > 31 * i / parts) & (F.lit(last) | (day <= 31 * (i + 1) / parts)))
        slice_.coalesce(2).select("value").write.mode("append").text(path)
    return path


@query("str_1_candle_append", PARSED)
def _(spark, d):
    landing, out = land(spark, broken(candle_messages(spark, d))), scratch(spark, "streamed", uuid4().hex)
    parsed = ST.candle_stream(ST.message_lines(spark, landing, files_per_trigger=2))
    detector.append_stream(parsed, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return ntz(spark.read.parquet(f"{out}/table"), "received_at", "candle_time")


@query("str_2_trade_append", TRADES)
def _(spark, d):
    path, out = scratch(spark, "landing", uuid4().hex), scratch(spark, "streamed", uuid4().hex)
    trade_messages(spark, d).repartition(4).write.text(path)
    parsed = ST.trade_stream(ST.message_lines(spark, path, files_per_trigger=2))
    detector.append_stream(parsed, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return ntz(spark.read.parquet(f"{out}/table"), "received_at")


def _detect(spark, d, cfg, files_per_trigger=None, revised=False, parts=3):
    landing = land(spark, candle_messages(spark, d, revised), parts)
    out = scratch(spark, "alerts", uuid4().hex)
    stream = ST.candle_stream(ST.message_lines(spark, landing, files_per_trigger))
    detector.sink_alerts(detector.detect_alerts(stream, cfg), out, f"{out}/checkpoint").awaitTermination()
    return out


def message_sql(sql):
    """The same query over candles as messages carry them: whole seconds, receipt in milliseconds."""
    return sql.replace("ts AS candle_time", "date_trunc('second', ts) AS candle_time").replace(
        "ts + to_milliseconds(event_id * 37 % 4000) AS received_at",
        "date_trunc('millisecond', ts + to_milliseconds(event_id * 37 % 4000)) AS received_at")


def once(sql):
    return sql.replace("FROM candles WHERE event_id % 7 = 0", "FROM candles WHERE false")


STREAMED = f"WITH {S.candidates(1, 55, 45, 2)} {S.FIRED} {alert_sql(55, 45, 2, 'alerts')}"


@query("str_5_stream_alerts", once(message_sql(STREAMED)))
def _(spark, d):
    """Keyed session state, rolling buffer and cooldown over several batches, into the idempotent sink."""
    out = _detect(spark, d, EAGER, files_per_trigger=2)
    return tidy(spark.read.parquet(f"{out}/alerts_v2").drop("batch_id")).drop("message")


@query("str_4_stream_revised_alerts", message_sql(STREAMED))
def _(spark, d):
    """Candles sent twice collapse to their last revision inside a batch."""
    out = _detect(spark, d, EAGER, files_per_trigger=2, revised=True)
    return tidy(spark.read.parquet(f"{out}/alerts_v2").drop("batch_id")).drop("message")


@query("str_15_stream_critical_feed", once(message_sql(f"WITH {S.candidates(1, 55, 45, 2)} {S.FIRED} " + alert_sql(
    55, 45, 2, "alerts", "alert_type IN ('COMBINED_PUMP_RISK', 'COMBINED_PANIC_SELL')"))))
def _(spark, d):
    out = _detect(spark, d, EAGER)
    return tidy(spark.read.parquet(f"{out}/critical").drop("batch_id")).drop("message")
