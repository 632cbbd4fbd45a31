"""Bars, aggregates, indicators, labels."""

from pyspark.sql import functions as F

from candlewright.operators import indicators as I
from candlewright.operators import latency as T
from candlewright.operators.bars import last_candles, latest_revisions
from candlewright.operators.sector import breadth, sector_daily
from candlewright.plans import flows
from candlewright.schemas import STOCK_SIGNAL_COLUMNS
from workbench import mapping as M
from workbench import sqlparts as S
from workbench.catalog import query, r, rounded, rx
from workbench.stage import stage


@query("agg_1_daily_bars", f"WITH {S.BARS} SELECT symbol, trade_date, open, high, low, close, volume FROM bars")
def _(spark, d):
    return M.bars(spark, d)


@query("agg_1_index_daily_bars", f"WITH {S.INDEX_BARS} SELECT symbol, trade_date, open, high, low, close, volume FROM bars")
def _(spark, d):
    return M.index_bars(spark, d)


@query("agg_2_sector_daily", f"""WITH {S.SECTOR}
SELECT sector_key, date_key, {r(6, 'price_change_pct')}, {r(2, 'total_trade_value', 'total_market_cap')},
       {r(6, 'avg_pe', 'avg_pb', 'avg_eps')}, stock_count FROM sector""")
def _(spark, d):
    s = stage(spark, d)
    out = sector_daily(s.fact_equity, s.dim_stock, s.dim_sector)
    return rounded(rounded(rounded(out, 6, "price_change_pct"), 2, "total_trade_value", "total_market_cap"),
                   6, "avg_pe", "avg_pb", "avg_eps")


@query("agg_3_latest_revision", f"WITH {S.REVISED} SELECT * FROM latest")
def _(spark, d):
    return latest_revisions(M.revised_candles(spark, d))


@query("agg_4_label_distribution", f"WITH {S.SIGNALS} " + " UNION ALL ".join(
    f"SELECT '{c}' AS signal, {c} AS label, count(*) AS n FROM signals GROUP BY {c}" for c in STOCK_SIGNAL_COLUMNS))
def _(spark, d):
    return flows.label_distribution(stage(spark, d).signals)


LAT = "date_diff('millisecond', candle_time, received_at)"
LATENCY_SUMMARY = f"""SELECT count(*) AS total, round(avg({LAT}), 1) AS avg_ms,
 round(quantile_cont({LAT}, 0.5), 1) AS p50_ms, round(quantile_cont({LAT}, 0.95), 1) AS p95_ms,
 round(quantile_cont({LAT}, 0.99), 1) AS p99_ms, CAST(min({LAT}) AS DOUBLE) AS min_ms, CAST(max({LAT}) AS DOUBLE) AS max_ms FROM """


@query("agg_5_latency_summary", f"WITH {S.CANDLES} {LATENCY_SUMMARY} candles")
def _(spark, d):
    return T.latency_summary(M.candles(spark, d))


@query("agg_5_latency_summary_window", f"""WITH {S.CANDLES} {LATENCY_SUMMARY} candles
WHERE CAST(candle_time AS DATE) = DATE '2024-01-15' AND candle_time >= TIMESTAMP '2024-01-15 14:00:00' - INTERVAL 600 MINUTE""")
def _(spark, d):
    return T.latency_summary(T.recent(M.candles(spark, d), "2024-01-15 14:00:00", 600))


@query("agg_6_latency_by_minute", f"""WITH {S.CANDLES}
SELECT date_trunc('minute', received_at) AS minute, count(*) AS msg_count, round(avg({LAT}), 6) AS avg_ms,
       round(quantile_cont({LAT}, 0.95), 6) AS p95_ms FROM candles GROUP BY 1""")
def _(spark, d):
    return T.latency_series(M.candles(spark, d), digits=6).withColumn("minute", F.col("minute").cast("timestamp_ntz"))


@query("agg_7_latency_histogram", f"""WITH {S.CANDLES}
SELECT CASE WHEN {LAT} < 500 THEN '<500ms' WHEN {LAT} < 1000 THEN '500–1000ms' WHEN {LAT} < 1500 THEN '1000–1500ms'
            WHEN {LAT} < 2000 THEN '1500–2000ms' WHEN {LAT} < 3000 THEN '2000–3000ms' ELSE '>3000ms' END AS bucket,
       count(*) AS cnt FROM candles GROUP BY 1""")
def _(spark, d):
    return T.latency_histogram(M.candles(spark, d))


@query("agg_8_throughput", f"""WITH {S.CANDLES} SELECT round(count(*) / 60.0, 6) AS mps FROM candles
WHERE CAST(candle_time AS DATE) = DATE '2024-01-15' AND received_at >= TIMESTAMP '2024-01-15 12:00:00' - INTERVAL 1 MINUTE""")
def _(spark, d):
    return T.throughput(M.candles(spark, d), "2024-01-15 12:00:00").select(F.round("mps", 6).cast("double").alias("mps"))


@query("agg_9_daily_counts", f"""WITH {S.candidates(1, 55, 45, 2)} {S.FIRED}
SELECT coalesce(a.day, b.day) AS day, coalesce(candles, 0) AS candles, coalesce(alerts, 0) AS alerts FROM
(SELECT CAST(candle_time AS DATE) AS day, count(*) AS candles FROM revised GROUP BY 1) a FULL JOIN
(SELECT CAST(candle_time AS DATE) AS day, count(*) AS alerts FROM alerts GROUP BY 1) b ON a.day = b.day""")
def _(spark, d):
    from workbench.q_streams import eager_alerts

    return T.daily_counts(M.revised_candles(spark, d), eager_alerts(spark, d))


@query("agg_10_breadth", f"""WITH {S.SECTOR}
SELECT date_key, count(*) FILTER (WHERE price_change_pct > 0) AS sectors_up,
       count(*) FILTER (WHERE price_change_pct < 0) AS sectors_down FROM sector GROUP BY 1""")
def _(spark, d):
    return breadth(stage(spark, d).fact_sector)


@query("agg_11_distinct_sectors", "SELECT DISTINCT n_name AS sector FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(spark, d):
    from candlewright.plans.serving import sector_names

    return sector_names(stage(spark, d).star)


@query("agg_11_symbols_on_day", "SELECT DISTINCT event_type AS symbol FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'")
def _(spark, d):
    return T.symbols_on_day(M.candles(spark, d), "2024-01-15")


# indicators -----------------------------------------------------------------------------------

def _daily(*columns, digits=4):
    def run(spark, d):
        return rounded(I.daily_indicators(M.bars(spark, d)).select("symbol", "trade_date", *columns), digits, *columns)
    return run


def _daily_sql(*columns, digits=4):
    return f"WITH {S.BARS} {S.INDICATORS} SELECT symbol, trade_date, {r(digits, *columns)} FROM indicators"


for _name, _columns, _digits in (
    ("win_1_price_change", ["price_change_pct"], 6),
    ("win_2_moving_averages", ["sma_20", "sma_50"], 4),
    ("win_3_exponential_averages", ["ema_12", "ema_26"], 4),
    ("win_4_macd", ["macd"], 4),
    ("win_5_rsi_wilder", ["rsi_14"], 5),
    ("win_9_typical_price", ["vwap"], 5),
):
    query(_name, _daily_sql(*_columns, digits=_digits))(_daily(*_columns, digits=_digits))


@query("win_5_index_indicators", f"""WITH {S.INDEX_BARS} {S.INDICATORS}
SELECT symbol, trade_date, {r(4, 'sma_20', 'sma_50', 'ema_12', 'ema_26', 'rsi_14', 'macd')}, {r(6, 'price_change_pct')}
FROM indicators""")
def _(spark, d):
    out = flows.index_indicators(M.index_bars(spark, d)).select(
        "symbol", "trade_date", "sma_20", "sma_50", "ema_12", "ema_26", "rsi_14", "macd", "price_change_pct")
    return rounded(rounded(out, 4, "sma_20", "sma_50", "ema_12", "ema_26", "rsi_14", "macd"), 6, "price_change_pct")


def _candle(column, digits, name=None):
    def run(spark, d):
        out = I.candle_indicators(latest_revisions(M.revised_candles(spark, d)))
        return rounded(out.select("symbol", "candle_time", column), digits, column)
    return run


def _candle_sql(column, digits):
    return f"WITH {S.REVISED} {S.STEPPED.format(src='latest')} SELECT symbol, candle_time, {r(digits, column)} FROM measured"


for _name, _column, _digits in (
    ("win_6_rsi_simple", "rsi_14", 2),
    ("win_7_rsi_chart", "rsi_chart", 6),
    ("win_12_volume_ratio", "volume_ratio", 2),
    ("win_13_volume_ratio_lenient", "volume_ratio_lenient", 6),
):
    query(_name, _candle_sql(_column, _digits))(_candle(_column, _digits))


@query("win_8_rsi_seeded", f"""WITH {S.REVISED} {S.STEPPED.format(src='latest')},
seeded AS (
  WITH RECURSIVE x(symbol, rn, g, l) AS (
    SELECT symbol, rn, gain, loss FROM measured WHERE rn = 15
    UNION ALL
    SELECT m.symbol, m.rn, (x.g * 13 + greatest(m.delta, 0)) / 14, (x.l * 13 + greatest(-m.delta, 0)) / 14
    FROM x JOIN measured m ON m.symbol = x.symbol AND m.rn = x.rn + 1
  ) SELECT * FROM x
)
SELECT m.symbol, m.candle_time, {rx(5, 'CASE WHEN s.rn IS NULL THEN NULL WHEN s.l = 0 THEN 100.0 ELSE 100 - 100 / (1 + s.g / s.l) END', 'rsi_seeded')}
FROM measured m LEFT JOIN seeded s ON s.symbol = m.symbol AND s.rn = m.rn""")
def _(spark, d):
    out = I.candle_rsi_seeded(latest_revisions(M.revised_candles(spark, d)))
    return rounded(out.select("symbol", "candle_time", "rsi_seeded"), 5, "rsi_seeded")


@query("win_10_session_vwap", f"""WITH {S.REVISED} {S.SESSION}
SELECT symbol, candle_time, {r(4, 'vwap')}, {r(3, 'sigma')} FROM banded""")
def _(spark, d):
    out = I.session_vwap(latest_revisions(M.revised_candles(spark, d)), session_only=True)
    return rounded(rounded(out.select("symbol", "candle_time", "vwap", "sigma"), 4, "vwap"), 3, "sigma")


INTRADAY = f"""WITH {S.CANDLES},
day_rows AS (SELECT *, (high + low + close) / 3 AS tp FROM candles WHERE symbol = 'click' AND CAST(candle_time AS DATE) = DATE '2024-01-15'),
running AS (
  SELECT *, sum(tp * volume) OVER w / nullif(sum(volume) OVER w, 0) AS vwap,
    sqrt(greatest(sum(tp * tp * volume) OVER w / nullif(sum(volume) OVER w, 0)
      - (sum(tp * volume) OVER w / nullif(sum(volume) OVER w, 0)) ** 2, 0)) AS sigma
  FROM day_rows WINDOW w AS (ORDER BY candle_time ROWS UNBOUNDED PRECEDING)
),
shown AS (SELECT * FROM running WHERE CAST(candle_time AS TIME) >= TIME '09:00:00' ORDER BY candle_time DESC LIMIT 300)"""


@query("win_10_intraday_view", INTRADAY + f"""
SELECT candle_time AS time, open, high, low, close AS price, volume AS quantity, {r(4, 'vwap')}, {r(3, 'sigma')} FROM shown""")
def _(spark, d):
    return rounded(rounded(I.intraday_view(M.candles(spark, d), "click", "2024-01-15"), 4, "vwap"), 3, "sigma")


@query("win_11_sigma_bands", f"""WITH {S.REVISED} {S.SESSION}
SELECT symbol, candle_time, {rx(3, 'vwap + 2 * coalesce(sigma, 0)', 'upper_band')},
       {rx(3, 'vwap - 2 * coalesce(sigma, 0)', 'lower_band')} FROM banded""")
def _(spark, d):
    out = I.sigma_bands(I.session_vwap(latest_revisions(M.revised_candles(spark, d)), session_only=True))
    return rounded(out.select("symbol", "candle_time", "upper_band", "lower_band"), 3, "upper_band", "lower_band")


@query("win_14_volume_spike", f"""WITH {S.REVISED} {S.STEPPED.format(src='latest')}
SELECT symbol, candle_time, {r(6, 'volume_avg_20')}, coalesce(volume >= 3 * volume_avg_20, false) AS volume_spike FROM measured""")
def _(spark, d):
    out = I.candle_indicators(latest_revisions(M.revised_candles(spark, d)))
    return rounded(out.select("symbol", "candle_time", "volume_avg_20", "volume_spike"), 6, "volume_avg_20")


@query("win_15_sector_median_pe", f"WITH {S.SIGNALS} SELECT symbol, trade_date, sector, {r(6, 'pe_median_sector')} FROM ready")
def _(spark, d):
    s = stage(spark, d)
    out = flows.with_sector_median(s.equity.select("symbol", "trade_date", "pe"), s.dim_stock)
    return rounded(out.select("symbol", "trade_date", "sector", "pe_median_sector"), 6, "pe_median_sector")


@query("win_16_previous_macd", f"WITH {S.SIGNALS} SELECT symbol, trade_date, {r(4, 'macd_prev')} FROM ready")
def _(spark, d):
    out = flows.with_previous_macd(stage(spark, d).equity.select("symbol", "trade_date", "macd"))
    return rounded(out.select("symbol", "trade_date", "macd_prev"), 4, "macd_prev")


@query("win_17_last_candles", f"""WITH {S.REVISED}
SELECT symbol, candle_time, close, volume FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY candle_time DESC) AS k FROM latest) WHERE k <= 50""")
def _(spark, d):
    return last_candles(M.revised_candles(spark, d)).select("symbol", "candle_time", "close", "volume")


# labels ---------------------------------------------------------------------------------------

for _i, _label in enumerate(STOCK_SIGNAL_COLUMNS, 1):
    def _fresh(spark, d, _label=_label):
        s = stage(spark, d)
        return flows.stock_signals(s.equity, s.dim_stock).select("symbol", "trade_date", _label)

    query(f"lbl_{_i}_{_label}", f"WITH {S.SIGNALS} SELECT symbol, trade_date, {_label} FROM signals")(_fresh)


@query("lbl_11_index_trend", f"WITH {S.INDEX} SELECT symbol, trade_date, signal_market_trend FROM index_facts")
def _(spark, d):
    return flows.index_signals(stage(spark, d).index).select("symbol", "trade_date", "signal_market_trend")


@query("lbl_12_index_rsi", f"WITH {S.INDEX} SELECT symbol, trade_date, signal_market_rsi FROM index_facts")
def _(spark, d):
    return flows.index_signals(stage(spark, d).index).select("symbol", "trade_date", "signal_market_rsi")
