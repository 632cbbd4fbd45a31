"""SQL building blocks of the oracle queries: each is a comma-free list of common table expressions."""

PRINTS = """
prints AS (
  SELECT upper(s_name) AS symbol, r_name AS idx, CAST(l_shipdate AS DATE) AS trade_date,
         l_extendedprice / l_quantity AS price, CAST(l_quantity AS BIGINT) AS volume,
         l_extendedprice, l_tax, l_discount,
         CAST(l_orderkey AS HUGEINT) * 8 + l_linenumber AS o1, l_partkey AS o2, l_suppkey AS o3
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
BARS = PRINTS + """,
bars AS (
  SELECT symbol, trade_date, arg_min(price, ROW(o1, o2, o3)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, ROW(o1, o2, o3)) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM prints GROUP BY ALL
)"""
INDEX_BARS = PRINTS + """,
bars AS (
  SELECT idx AS symbol, trade_date, arg_min(price, ROW(o1, o2, o3)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, ROW(o1, o2, o3)) AS close, CAST(sum(volume) AS BIGINT) AS volume
  FROM prints GROUP BY ALL
)"""
# Sequential recurrences over numbered bars.
INDICATORS = """,
numbered AS MATERIALIZED (
  SELECT *, row_number() OVER w AS rn, lag(close) OVER w AS prev,
         CASE WHEN row_number() OVER w >= 20 THEN avg(close) OVER (w ROWS 19 PRECEDING) END AS sma_20,
         CASE WHEN row_number() OVER w >= 50 THEN avg(close) OVER (w ROWS 49 PRECEDING) END AS sma_50
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY trade_date)
),
smoothed AS (
  WITH RECURSIVE r(symbol, rn, e12, e26, gain, loss) AS (
    SELECT symbol, rn, close, close, CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM numbered WHERE rn = 1
    UNION ALL
    SELECT n.symbol, n.rn, r.e12 * 11 / 13 + n.close * 2 / 13, r.e26 * 25 / 27 + n.close * 2 / 27,
           CASE WHEN n.rn = 2 THEN greatest(n.close - n.prev, 0) ELSE r.gain * 13 / 14 + greatest(n.close - n.prev, 0) / 14 END,
           CASE WHEN n.rn = 2 THEN greatest(n.prev - n.close, 0) ELSE r.loss * 13 / 14 + greatest(n.prev - n.close, 0) / 14 END
    FROM r JOIN numbered n ON n.symbol = r.symbol AND n.rn = r.rn + 1
  ) SELECT * FROM r
),
indicators AS MATERIALIZED (
  SELECT n.symbol, n.trade_date, n.open, n.high, n.low, n.close, n.volume AS total_volume,
         n.close / n.prev - 1 AS price_change_pct, n.sma_20, n.sma_50, s.e12 AS ema_12, s.e26 AS ema_26,
         CASE WHEN s.loss = 0 THEN 100.0 ELSE 100 - 100 / (1 + s.gain / s.loss) END AS rsi_14,
         s.e12 - s.e26 AS macd, (n.high + n.low + n.close) / 3 AS vwap
  FROM numbered n JOIN smoothed s ON s.symbol = n.symbol AND s.rn = n.rn
)"""
SUMMARY = """,
figures AS (
  SELECT symbol, trade_date, max(price) AS h, min(price) AS l, avg(price) AS p, sum(l_extendedprice) AS market_cap,
         10000 * avg(l_tax) AS eps, 250 * avg(l_discount) AS roe, 125 * avg(l_tax) AS dividend_yield
  FROM prints GROUP BY ALL
),
ranged AS (
  SELECT *, max(h) OVER w AS high_52w, min(l) OVER w AS low_52w FROM figures
  WINDOW w AS (PARTITION BY symbol ORDER BY trade_date ROWS BETWEEN 252 PRECEDING AND 1 PRECEDING)
),
summary AS MATERIALIZED (
  SELECT symbol, trade_date, high_52w, low_52w, CAST(NULL AS DOUBLE) AS beta, eps, CAST(NULL AS DOUBLE) AS bvps,
         market_cap, CASE WHEN eps <> 0 THEN p / eps END AS pe, p / 2000 AS pb, roe, dividend_yield
  FROM ranged WHERE day(trade_date) % 4 <> 1
)"""
EQUITY = BARS + INDICATORS + SUMMARY + """,
equity AS MATERIALIZED (
  SELECT i.*, s.high_52w, s.low_52w, s.beta, s.eps, s.bvps, s.market_cap, s.pe, s.pb, s.roe, s.dividend_yield
  FROM indicators i LEFT JOIN summary s ON s.symbol = i.symbol AND s.trade_date = i.trade_date
),
stocks AS (
  SELECT upper(s_name) AS symbol, s_suppkey AS sid, n_name AS sector, n_nationkey AS sector_id, r_name AS exchange,
         CAST(row_number() OVER (ORDER BY upper(s_name)) AS INTEGER) AS stock_key,
         'Company ' || s_suppkey AS name, 'Co ' || right(s_name, 4) AS organ_short_name,
         CASE WHEN s_suppkey % 7 = 0 THEN 'FUND' ELSE 'STOCK' END AS type
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""
SIGNALS = EQUITY + """,
ready AS (
  SELECT e.*, t.sector, lag(e.macd) OVER (PARTITION BY e.symbol ORDER BY e.trade_date) AS macd_prev,
         median(e.pe) OVER (PARTITION BY t.sector, e.trade_date) AS pe_median_sector
  FROM equity e JOIN stocks t ON t.symbol = e.symbol
),
single AS (
  SELECT *,
    CASE WHEN rsi_14 IS NULL THEN NULL WHEN rsi_14 <= 30 THEN 'Quá bán' WHEN rsi_14 >= 70 THEN 'Quá mua' ELSE 'Trung tính' END AS signal_rsi,
    CASE WHEN sma_20 IS NULL OR sma_50 IS NULL THEN NULL
         WHEN close > sma_20 AND sma_20 > sma_50 THEN 'Tăng mạnh' WHEN close > sma_20 THEN 'Tăng nhẹ'
         WHEN sma_20 > sma_50 THEN 'Giảm nhẹ' ELSE 'Giảm mạnh' END AS signal_trend,
    CASE WHEN macd IS NULL THEN NULL WHEN macd > 0 AND macd > macd_prev THEN 'Tăng'
         WHEN macd < 0 AND macd < macd_prev THEN 'Giảm' ELSE 'Trung tính' END AS signal_macd,
    CASE WHEN dividend_yield IS NULL OR dividend_yield <= 0 THEN 'Không có' WHEN dividend_yield > 8 THEN 'Hấp dẫn'
         WHEN dividend_yield >= 4 THEN 'Khá' ELSE 'Thấp' END AS signal_dividend,
    CASE WHEN roe IS NULL THEN NULL WHEN roe >= 20 THEN 'Xuất sắc' WHEN roe >= 15 THEN 'Tốt'
         WHEN roe >= 10 THEN 'Trung bình' ELSE 'Yếu' END AS signal_roe,
    CASE WHEN pe IS NULL OR pe <= 0 OR pe_median_sector IS NULL OR pe_median_sector <= 0 THEN 'N/A'
         WHEN pe / pe_median_sector < 0.85 THEN 'Rẻ' WHEN pe / pe_median_sector <= 1.15 THEN 'Hợp lý' ELSE 'Đắt' END AS signal_pe,
    CASE WHEN pb IS NULL OR pb <= 0 THEN 'N/A' WHEN pb < 1 THEN 'Rẻ' WHEN pb <= 3 THEN 'Hợp lý' ELSE 'Đắt' END AS signal_pb,
    CASE WHEN high_52w IS NULL OR low_52w IS NULL OR high_52w - low_52w <= 0 THEN NULL
         WHEN (close - low_52w) / (high_52w - low_52w) >= 0.8 THEN 'Gần đỉnh'
         WHEN (close - low_52w) / (high_52w - low_52w) <= 0.2 THEN 'Gần đáy' ELSE 'Trung bình' END AS signal_price_pos
  FROM ready
),
signals AS MATERIALIZED (
  SELECT *,
    CASE WHEN signal_roe IS NULL OR signal_pe = 'N/A' THEN NULL
         WHEN signal_roe IN ('Xuất sắc', 'Tốt') THEN CASE signal_pe WHEN 'Rẻ' THEN 'Hàng hiệu giá hời' WHEN 'Hợp lý' THEN 'Tăng trưởng bền vững' ELSE 'Tăng trưởng nóng' END
         WHEN signal_roe = 'Trung bình' THEN CASE signal_pe WHEN 'Rẻ' THEN 'Đầu tư an toàn' WHEN 'Hợp lý' THEN 'Theo dõi thêm' ELSE 'Bị định giá cao' END
         ELSE CASE signal_pe WHEN 'Rẻ' THEN 'Bẫy định giá' WHEN 'Hợp lý' THEN 'Cổ phiếu yếu' ELSE 'Rủi ro cao' END END AS label_stock_class,
    CASE WHEN rsi_14 IS NULL OR sma_20 IS NULL THEN NULL
         WHEN CAST(rsi_14 <= 40 AS INT) + CAST(signal_macd = 'Tăng' AS INT) + CAST(close > sma_20 AS INT) = 3 THEN 'Mua mạnh'
         WHEN CAST(rsi_14 <= 40 AS INT) + CAST(signal_macd = 'Tăng' AS INT) + CAST(close > sma_20 AS INT) = 2 THEN 'Mua'
         WHEN CAST(rsi_14 >= 65 AS INT) + CAST(signal_macd = 'Giảm' AS INT) + CAST(close < sma_20 AS INT) = 3 THEN 'Bán mạnh'
         WHEN CAST(rsi_14 >= 65 AS INT) + CAST(signal_macd = 'Giảm' AS INT) + CAST(close < sma_20 AS INT) = 2 THEN 'Bán'
         ELSE 'Nắm giữ' END AS label_trading_action
  FROM single
)"""
DATE_KEY = "CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"
SECTOR_TAIL = f""",
sector AS MATERIALIZED (
  SELECT CAST(t.sector_id AS INTEGER) AS sector_key, {DATE_KEY.format(c='e.trade_date')} AS date_key,
         sum(coalesce(price_change_pct, 0) * coalesce(market_cap, 0)) / nullif(sum(coalesce(market_cap, 0)), 0) AS price_change_pct,
         sum(coalesce(close, 0) * coalesce(total_volume, 0)) AS total_trade_value,
         sum(coalesce(market_cap, 0)) AS total_market_cap,
         sum(CASE WHEN pe > 0 THEN coalesce(market_cap, 0) END) / nullif(sum(CASE WHEN pe > 0 THEN coalesce(market_cap, 0) / pe END), 0) AS avg_pe,
         sum(CASE WHEN pb > 0 THEN coalesce(market_cap, 0) END) / nullif(sum(CASE WHEN pb > 0 THEN coalesce(market_cap, 0) / pb END), 0) AS avg_pb,
         avg(eps) AS avg_eps, CAST(count(DISTINCT t.stock_key) AS INTEGER) AS stock_count
  FROM equity e JOIN stocks t ON t.symbol = e.symbol GROUP BY ALL
)"""
SECTOR = EQUITY + SECTOR_TAIL
INDEX = INDEX_BARS + INDICATORS + """,
index_facts AS (
  SELECT CAST(r_regionkey AS BIGINT) AS index_key, i.*,
    CASE WHEN sma_20 IS NULL OR sma_50 IS NULL THEN NULL
         WHEN close > sma_20 AND sma_20 > sma_50 THEN 'Tăng mạnh' WHEN close > sma_20 THEN 'Tăng nhẹ'
         WHEN sma_20 > sma_50 THEN 'Giảm nhẹ' ELSE 'Giảm mạnh' END AS signal_market_trend,
    CASE WHEN rsi_14 IS NULL THEN NULL WHEN rsi_14 <= 30 THEN 'Quá bán' WHEN rsi_14 >= 70 THEN 'Quá mua' ELSE 'Trung tính' END AS signal_market_rsi
  FROM indicators i JOIN region ON r_name = i.symbol
)"""
CANDLES = """
candles AS (
  SELECT event_id, event_type AS symbol, ts AS candle_time,
         ts + to_milliseconds(event_id * 37 % 4000) AS received_at,
         50 + CAST(json_extract(props, '$.k') AS DOUBLE) AS open,
         50 + CAST(json_extract(props, '$.k') AS DOUBLE) + event_id % 3 AS high,
         50 + CAST(json_extract(props, '$.k') AS DOUBLE) - event_id % 2 AS low,
         50 + CAST(json_extract(props, '$.k') AS DOUBLE) AS close,
         CAST(round(value * 10) AS BIGINT) AS volume
  FROM events
)"""
REVISED = CANDLES + """,
revised AS (
  SELECT * FROM candles UNION ALL
  SELECT event_id, symbol, candle_time, received_at + INTERVAL 1 SECOND, open, high + 3, low, close + 2, volume + 5
  FROM candles WHERE event_id % 7 = 0
),
latest AS MATERIALIZED (
  SELECT symbol, candle_time, arg_max(open, received_at) AS open, arg_max(high, received_at) AS high,
         arg_max(low, received_at) AS low, arg_max(close, received_at) AS close,
         arg_max(volume, received_at) AS volume, max(received_at) AS received_at
  FROM revised GROUP BY ALL
)"""
SESSION = """,
in_session AS (
  SELECT *, (high + low + close) / 3 AS tp,
         CASE WHEN CAST(candle_time AS TIME) BETWEEN TIME '09:00:00' AND TIME '14:45:00' THEN volume ELSE 0 END AS v
  FROM latest
),
summed AS (
  SELECT *, sum(v) OVER w AS sv, sum(tp * v) OVER w AS spv, sum(tp * tp * v) OVER w AS sp2v FROM in_session
  WINDOW w AS (PARTITION BY symbol, CAST(candle_time AS DATE) ORDER BY candle_time ROWS UNBOUNDED PRECEDING)
),
banded AS (
  SELECT *, CASE WHEN sv > 0 THEN spv / sv END AS vwap,
         CASE WHEN sv > 0 THEN sqrt(greatest(sp2v / sv - (spv / sv) * (spv / sv), 0)) END AS sigma FROM summed
)"""
STEPPED = """,
stepped AS (
  SELECT *, row_number() OVER w AS rn, close - lag(close) OVER w AS delta FROM {src}
  WINDOW w AS (PARTITION BY symbol ORDER BY candle_time)
),
frames AS (
  SELECT *, sum(greatest(delta, 0)) OVER w14 / 14 AS gain, sum(greatest(-delta, 0)) OVER w14 / 14 AS loss,
         avg(volume) OVER prior20 AS prior_mean, count(volume) OVER prior20 AS prior_n, avg(volume) OVER w20 AS mean_20
  FROM stepped
  WINDOW w14 AS (PARTITION BY symbol ORDER BY candle_time ROWS 13 PRECEDING),
         w20 AS (PARTITION BY symbol ORDER BY candle_time ROWS 19 PRECEDING),
         prior20 AS (PARTITION BY symbol ORDER BY candle_time ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)
),
measured AS MATERIALIZED (
  SELECT *,
    CASE WHEN rn < 15 THEN NULL WHEN loss = 0 THEN 100.0 WHEN gain = 0 THEN 0.0 ELSE CAST(format('{{:.2f}}', 100 - 100 / (1 + gain / loss)) AS DOUBLE) END AS rsi_14,
    CASE WHEN rn >= 14 AND loss <> 0 THEN 100 - 100 / (1 + gain / loss) END AS rsi_chart,
    CASE WHEN prior_n = 20 AND prior_mean > 0 THEN CAST(format('{{:.2f}}', volume / prior_mean) AS DOUBLE) END AS volume_ratio,
    CASE WHEN coalesce(prior_mean, 1) > 0 THEN volume / coalesce(prior_mean, 1) ELSE 0 END AS volume_ratio_lenient,
    CASE WHEN rn >= 20 THEN mean_20 END AS volume_avg_20
  FROM frames
)"""
ENRICHED = REVISED + SESSION + STEPPED.format(src="banded")


def candidates(k: float, high: float, low: float, spike: float) -> str:
    """Combined-rule candidates with their thresholds."""
    return ENRICHED + f""",
states AS (
  SELECT *, CASE WHEN vwap > 0 AND sigma > 0 AND close > vwap + {k} * sigma THEN 'UP'
                 WHEN vwap > 0 AND sigma > 0 AND close < vwap - {k} * sigma THEN 'DOWN' ELSE 'IN' END AS state,
         coalesce(rsi_14 >= {high}, false) AS hot, coalesce(rsi_14 <= {low}, false) AS cold,
         coalesce(volume_ratio >= {spike}, false) AS spike FROM measured
),
candidates AS MATERIALIZED (
  SELECT * FROM (SELECT *, CASE
    WHEN state = 'UP' AND hot AND spike THEN 'COMBINED_PUMP_RISK'
    WHEN state = 'DOWN' AND cold AND spike THEN 'COMBINED_PANIC_SELL'
    WHEN state = 'UP' AND hot THEN 'COMBINED_OVERBOUGHT_BREAKOUT'
    WHEN state = 'DOWN' AND cold THEN 'COMBINED_OVERSOLD_BREAKDOWN'
    WHEN spike AND state = 'IN' THEN 'COMBINED_UNUSUAL_VOLUME'
    WHEN spike AND state = 'UP' THEN 'COMBINED_VOLUME_BREAKOUT'
    WHEN spike THEN 'COMBINED_VOLUME_BREAKDOWN' END AS alert_type FROM states)
  WHERE alert_type IS NOT NULL
)"""


FIRED = """,
ordered AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol, alert_type ORDER BY candle_time) AS an FROM candidates
),
fired AS (
  WITH RECURSIVE f(symbol, alert_type, an, last_fired, fires) AS (
    SELECT symbol, alert_type, an, candle_time, true FROM ordered WHERE an = 1
    UNION ALL
    SELECT o.symbol, o.alert_type, o.an,
           CASE WHEN o.candle_time >= f.last_fired + INTERVAL 300 SECOND THEN o.candle_time ELSE f.last_fired END,
           o.candle_time >= f.last_fired + INTERVAL 300 SECOND
    FROM f JOIN ordered o ON o.symbol = f.symbol AND o.alert_type = f.alert_type AND o.an = f.an + 1
  ) SELECT * FROM f
),
alerts AS MATERIALIZED (
  SELECT o.* FROM ordered o JOIN fired f ON f.symbol = o.symbol AND f.alert_type = o.alert_type AND f.an = o.an WHERE f.fires
)"""
CALENDAR = """
days AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders),
day_events AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS event_name,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'holiday' ELSE ' ' END AS event_type
  FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
)"""
PUBLISHED_CALENDAR = CALENDAR + f""",
merged AS (
  SELECT date, string_agg(event_name, '; ' ORDER BY event_name) AS event_name,
         max(CASE WHEN trim(event_type) <> '' THEN 1 ELSE 0 END) AS holiday FROM day_events GROUP BY date
),
calendar AS MATERIALIZED (
  SELECT {DATE_KEY.format(c='d.date')} AS date_key, d.date AS trade_date, CAST(year(d.date) AS BIGINT) AS cal_year,
         CAST(quarter(d.date) AS INTEGER) AS cal_quarter, CAST(month(d.date) AS INTEGER) AS cal_month,
         CAST(week(d.date) AS INTEGER) AS cal_week,
         CASE WHEN isodow(d.date) >= 6 THEN 'Cuối tuần' ELSE m.event_name END AS event_name,
         CAST(CASE WHEN isodow(d.date) >= 6 OR coalesce(m.holiday, 0) = 1 THEN 1 ELSE 0 END AS TINYINT) AS is_day_off
  FROM days d LEFT JOIN merged m ON m.date = d.date
)"""
