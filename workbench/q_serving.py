"""Served queries over the published star."""

from candlewright.operators import latency as T
from candlewright.plans import serving as Q
from candlewright.schemas import STOCK_SIGNAL_COLUMNS
from workbench import mapping as M
from workbench import sqlparts as S
from workbench.catalog import query, r, rounded, rx
from workbench.q_streams import alert_sql, eager_alerts, tidy
from workbench.stage import stage

LATEST = "trade_date = (SELECT max(trade_date) FROM equity)"
MATCH = "(symbol ILIKE '%04%' OR name ILIKE '%04%' OR organ_short_name ILIKE '%co 00%')"
SYMBOL = "SUPPLIER#000000007"


@query("qry_1_stock_list", f"WITH {S.EQUITY} SELECT stock_key, symbol, name, sector, exchange, organ_short_name FROM stocks WHERE symbol ILIKE '%r#00000000%' OR name ILIKE '%r#00000000%' ORDER BY symbol LIMIT 20 OFFSET 5")
def _(spark, d):
    page = Q.stock_list(stage(spark, d).star, limit=20, offset=5, search="R#00000000")
    return page.select("stock_key", "symbol", "name", "sector", "exchange", "organ_short_name")


@query("qry_1_stock_total", f"WITH {S.EQUITY} SELECT count(*) AS total FROM stocks WHERE exchange = 'ASIA' AND (symbol ILIKE '%co%' OR name ILIKE '%co%' OR organ_short_name ILIKE '%co%')")
def _(spark, d):
    return Q.stock_total(stage(spark, d).star, search="Co", exchange="ASIA")


@query("qry_2_stock_detail", f"WITH {S.EQUITY} SELECT stock_key, symbol, name, sector, exchange, type FROM stocks WHERE symbol = '{SYMBOL}'")
def _(spark, d):
    return Q.stock_detail(stage(spark, d).star, SYMBOL).select("stock_key", "symbol", "name", "sector", "exchange", "type")


HISTORY = ["price_change_pct", "sma_20", "sma_50", "ema_12", "ema_26", "rsi_14", "macd", "vwap", "pe", "pb", "roe", "eps", "bvps",
           "market_cap", "dividend_yield", "high_52w", "low_52w", "beta"]


@query("qry_3_stock_history", f"""WITH {S.EQUITY} SELECT symbol, trade_date, open, high, low, close, total_volume, {r(4, *HISTORY)}
FROM equity WHERE symbol = '{SYMBOL}' AND trade_date BETWEEN DATE '1997-01-01' AND DATE '2000-12-31' ORDER BY trade_date DESC LIMIT 90""")
def _(spark, d):
    return rounded(Q.stock_history(stage(spark, d).star, SYMBOL, "1997-01-01", "2000-12-31"), 4, *HISTORY)


@query("qry_4_signal_history", f"""WITH {S.SIGNALS} SELECT symbol, trade_date, {', '.join(STOCK_SIGNAL_COLUMNS)}
FROM signals WHERE symbol = '{SYMBOL}' ORDER BY trade_date DESC LIMIT 30""")
def _(spark, d):
    return Q.signal_history(stage(spark, d).star, SYMBOL)


ITEMS = "FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 10 <> 3 AND upper(c_name) = 'CUSTOMER#000000017'"


@query("qry_5_news_history", f"""SELECT upper(c_name) AS symbol, CAST(o_orderdate AS DATE) AS trade_date, 'News ' || o_orderkey AS news_title,
o_orderpriority AS news_short_content, CAST(NULL AS VARCHAR) AS news_image_url, 'src/' || o_orderkey AS news_source_link
{ITEMS} ORDER BY o_orderdate DESC, 3 LIMIT 20""")
def _(spark, d):
    return Q.news_history(stage(spark, d).company_star, "CUSTOMER#000000017")


@query("qry_6_event_history", f"""SELECT upper(c_name) AS symbol, CAST(o_orderdate AS DATE) AS trade_date, o_orderpriority AS event_name_vi,
'Order ' || o_orderkey AS event_title_vi, o_orderstatus AS event_code {ITEMS} ORDER BY o_orderdate DESC, 4 LIMIT 20""")
def _(spark, d):
    return Q.event_history(stage(spark, d).company_star, "CUSTOMER#000000017")


SCREEN = f"""FROM signals s JOIN stocks t ON t.symbol = s.symbol WHERE s.trade_date = (SELECT max(trade_date) FROM signals)"""
SCREEN_VALUES = ["price_change_pct", "pe", "pb", "roe", "eps", "market_cap", "dividend_yield", "rsi_14", "macd", "beta", "high_52w", "low_52w"]


@query("qry_7_screener", f"""WITH {S.SIGNALS} SELECT t.symbol, organ_short_name, t.sector, exchange, trade_date, close, {r(4, *SCREEN_VALUES)},
label_stock_class, label_trading_action {SCREEN} ORDER BY rsi_14 DESC NULLS LAST, t.symbol LIMIT 15 OFFSET 2""")
def _(spark, d):
    return rounded(Q.screener(stage(spark, d).star, sort_by="rsi_14", limit=15, offset=2), 4, *SCREEN_VALUES)


@query("qry_7_screener_filtered", f"""WITH {S.SIGNALS} SELECT t.symbol, close, {rx(4, 'rsi_14', 'rsi_14')}, label_trading_action
{SCREEN} AND rsi_14 >= 35 AND rsi_14 <= 65 AND label_trading_action ILIKE '%bán%' ORDER BY close, t.symbol LIMIT 50""")
def _(spark, d):
    page = Q.screener(stage(spark, d).star, sort_by="close", sort_order="asc", signal="Bán", ranges={"rsi_14": (35, 65)})
    return rounded(page.select("symbol", "close", "rsi_14", "label_trading_action"), 4, "rsi_14")


@query("qry_7_screener_total", f"WITH {S.SIGNALS} SELECT count(*) AS total {SCREEN} AND label_trading_action ILIKE '%mua%' AND rsi_14 <= 80")
def _(spark, d):
    return Q.screener_total(stage(spark, d).star, signal="mua", ranges={"rsi_14": (None, 80)})


INDEX_VALUES = ["price_change_pct", "sma_20", "sma_50", "rsi_14", "macd"]


@query("qry_8_indices_latest", f"""WITH {S.INDEX} SELECT symbol AS index_symbol, symbol AS index_name, trade_date, open, high, low, close, total_volume,
{r(4, *INDEX_VALUES)}, signal_market_trend, signal_market_rsi FROM index_facts WHERE trade_date = (SELECT max(trade_date) FROM index_facts)""")
def _(spark, d):
    return rounded(Q.indices_latest(stage(spark, d).index_star), 4, *INDEX_VALUES)


@query("qry_9_index_history", f"""WITH {S.INDEX} SELECT symbol, trade_date, open, high, low, close, total_volume, {r(4, *INDEX_VALUES, 'ema_12', 'ema_26')},
signal_market_trend, signal_market_rsi FROM index_facts WHERE symbol = 'ASIA' ORDER BY trade_date DESC LIMIT 90""")
def _(spark, d):
    return rounded(Q.index_history(stage(spark, d).index_star, "ASIA"), 4, *INDEX_VALUES, "ema_12", "ema_26")


for _side, _gainers, _order in (("gainers", True, "DESC"), ("losers", False, "ASC")):
    def _movers(spark, d, _gainers=_gainers):
        return rounded(Q.top_movers(stage(spark, d).star, _gainers), 6, "price_change_pct")

    def _sectors(spark, d, _gainers=_gainers):
        return rounded(rounded(Q.top_sectors(stage(spark, d).star, _gainers), 6, "price_change_pct"), 2, "total_market_cap", "total_trade_value")

    query(f"qry_10_top_{_side}", f"""WITH {S.EQUITY} SELECT symbol, close, {r(6, 'price_change_pct')} FROM equity
WHERE {LATEST} AND price_change_pct IS NOT NULL ORDER BY equity.price_change_pct {_order}, symbol LIMIT 10""")(_movers)
    query(f"qry_11_top_sector_{_side}", f"""WITH {S.SECTOR} SELECT n_name AS sector, {r(6, 'price_change_pct')}, {r(2, 'total_market_cap', 'total_trade_value')}
FROM sector JOIN nation ON n_nationkey = sector_key WHERE date_key = (SELECT max(date_key) FROM sector) AND price_change_pct IS NOT NULL
ORDER BY sector.price_change_pct {_order}, n_name LIMIT 5""")(_sectors)


# The published calendar also holds days that were only traded on.
ALL_DAYS = S.PUBLISHED_CALENDAR.replace(
    "AS date FROM orders),", "AS date FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem),", 1)


@query("qry_12_month_calendar", f"""WITH {ALL_DAYS} SELECT trade_date, event_name, is_day_off FROM calendar
WHERE cal_year = 1998 AND cal_month = 3 AND (event_name <> '' OR is_day_off = 1)""")
def _(spark, d):
    return Q.month_calendar(stage(spark, d).star, 1998, 3)


MEASURES = f"{r(6, 'price_change_pct')}, {r(2, 'total_trade_value', 'total_market_cap')}, {r(6, 'avg_pe', 'avg_pb', 'avg_eps')}, stock_count"
SECTOR_SQL = f"sector_key, n_name AS sector, strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS trade_date, {MEASURES} FROM sector JOIN nation ON n_nationkey = sector_key"


def measured(df):
    return rounded(rounded(df, 6, "price_change_pct", "avg_pe", "avg_pb", "avg_eps"), 2, "total_trade_value", "total_market_cap")


@query("qry_13_sectors_latest", f"WITH {S.SECTOR} SELECT {SECTOR_SQL} WHERE date_key = (SELECT max(date_key) FROM sector)")
def _(spark, d):
    return measured(Q.sectors_latest(stage(spark, d).star))


@query("qry_14_sector_detail", f"WITH {S.SECTOR} SELECT {SECTOR_SQL} WHERE sector_key = 7 AND date_key = (SELECT max(date_key) FROM sector WHERE sector_key = 7)")
def _(spark, d):
    return measured(Q.sector_detail(stage(spark, d).star, 7))


@query("qry_14_sector_details", f"WITH {S.SECTOR} SELECT {SECTOR_SQL} WHERE date_key = (SELECT max(date_key) FROM sector x WHERE x.sector_key = sector.sector_key)")
def _(spark, d):
    return measured(Q.sector_details(stage(spark, d).star))


@query("qry_15_sector_top_stocks", f"""WITH {S.SIGNALS} SELECT t.symbol, organ_short_name, trade_date, close, {r(4, 'price_change_pct', 'market_cap', 'pe', 'pb', 'eps')}
{SCREEN} AND t.sector = (SELECT n_name FROM nation WHERE n_nationkey = 16) ORDER BY s.market_cap DESC NULLS LAST, t.symbol LIMIT 15""")
def _(spark, d):
    return rounded(Q.sector_top_stocks(stage(spark, d).star, 16), 4, "price_change_pct", "market_cap", "pe", "pb", "eps")


@query("qry_16_sector_history", f"""WITH {S.SECTOR} SELECT n_name AS sector_name, strptime(date_key::VARCHAR, '%Y%m%d')::DATE AS trade_date, {MEASURES}
FROM sector JOIN nation ON n_nationkey = sector_key WHERE sector_key = 7 AND date_key >= 19970101 ORDER BY date_key DESC LIMIT 90""")
def _(spark, d):
    return measured(Q.sector_history(stage(spark, d).star, 7, start="1997-01-01"))


@query("qry_17_alerts_of_day", f"WITH {S.candidates(1, 55, 45, 2)} {S.FIRED}, chosen AS (SELECT * FROM alerts WHERE CAST(candle_time AS DATE) = DATE '2024-01-15' AND symbol = 'click' ORDER BY candle_time DESC, alert_type LIMIT 50) "
       + alert_sql(55, 45, 2, "chosen"))
def _(spark, d):
    return tidy(Q.alerts_of_day(eager_alerts(spark, d), "2024-01-15", symbol="click", rule="COMBINED")).drop("message")


@query("qry_18_last_price", f"WITH {S.CANDLES} SELECT close, candle_time FROM candles WHERE symbol = 'view' AND CAST(candle_time AS DATE) = DATE '2024-01-20' ORDER BY candle_time DESC LIMIT 1")
def _(spark, d):
    return Q.last_price(M.candles(spark, d), "view", "2024-01-20")


@query("qry_18_last_prices", f"""WITH {S.CANDLES} SELECT symbol, CAST(candle_time AS DATE) AS day, arg_max(close, candle_time) AS close,
max(candle_time) AS candle_time FROM candles GROUP BY 1, 2""")
def _(spark, d):
    return Q.last_prices(M.candles(spark, d))


@query("qry_19_latest_message", f"""WITH {S.CANDLES} SELECT symbol, candle_time, received_at, date_diff('millisecond', candle_time, received_at) AS latency_ms
FROM candles ORDER BY received_at DESC, symbol LIMIT 1""")
def _(spark, d):
    return T.latest_message(M.candles(spark, d))


@query("qry_20_sector_table", f"WITH {S.SECTOR} SELECT {SECTOR_SQL} WHERE date_key = (SELECT max(date_key) FROM sector) ORDER BY coalesce(avg_pe, 0) DESC")
def _(spark, d):
    return measured(Q.sector_table(Q.sectors_latest(stage(spark, d).star), "avg_pe"))
