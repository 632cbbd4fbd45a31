"""Column names and types of the raw, star-schema and stream tables."""

from pyspark.sql.types import (
    ByteType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


_S, _D, _L, _I, _DATE, _TS = (
    StringType(), DoubleType(), LongType(), IntegerType(), DateType(), TimestampType(),
)

SUMMARY_METRICS = [
    "high_52w", "low_52w", "beta", "eps", "bvps", "market_cap", "pe", "pb", "roe", "dividend_yield",
]
RAW_SUMMARY_METRICS = [
    "high_52w", "low_52w", "dividend", "beta", "eps", "bvps", "market_cap", "pe", "pb", "roe",
    "change_1m", "change_1y", "dividend_yield", "foreign_ownership_pct",
]
RAW_OHLC_COLUMNS = ["symbol", "time", "open", "high", "low", "close", "volume"]
RAW_SUMMARY_COLUMNS = ["symbol", "date", *RAW_SUMMARY_METRICS, "ingested_at"]
BAR_COLUMNS = ["symbol", "trade_date", "open", "high", "low", "close", "volume"]

INDICATOR_COLUMNS = ["price_change_pct", "sma_20", "sma_50", "ema_12", "ema_26", "rsi_14", "macd"]
EQUITY_COLUMNS = [
    "symbol", "trade_date", "open", "high", "low", "close", "total_volume",
    *INDICATOR_COLUMNS, "vwap", *SUMMARY_METRICS,
]
INDEX_COLUMNS = [
    "symbol", "trade_date", "open", "high", "low", "close", "total_volume", *INDICATOR_COLUMNS,
]
STOCK_SIGNAL_COLUMNS = [
    "signal_rsi", "signal_trend", "signal_macd", "signal_dividend", "signal_roe", "signal_pe",
    "signal_pb", "signal_price_pos", "label_stock_class", "label_trading_action",
]
INDEX_SIGNAL_COLUMNS = ["signal_market_trend", "signal_market_rsi"]
EVENT_COLUMNS = ["symbol", "public_date", "event_name_vi", "event_title_vi", "event_code"]
NEWS_COLUMNS = [
    "symbol", "public_date", "news_title", "news_short_content", "news_image_url", "news_source_link",
]
CALENDAR_COLUMNS = [
    "trade_date", "cal_year", "cal_quarter", "cal_month", "cal_week", "event_name", "is_day_off",
]
SCD_COLUMNS = ["symbol", "index_id", "effective_from", "effective_to", "is_current"]
ALERT_COLUMNS = [
    "alert_time", "symbol", "rule_name", "alert_type", "severity", "price", "indicator_value",
    "threshold", "deviation_pct", "message",
]

DIM_STOCK = _struct(
    stock_key=_I, symbol=_S, name=_S, sector=_S, profile=_S, listing_date=_S, issued_share=_D,
    exchange=_S, type=_S, organ_short_name=_S, organ_name=_S,
)
DIM_INDEX = _struct(index_key=_L, index_symbol=_S, index_name=_S, description=_S, group=_S)
DIM_DATE_EVENT = _struct(
    date_key=_I, trade_date=_DATE, cal_year=_I, cal_quarter=_I, cal_month=_I, cal_week=_I,
    event_name=_S, is_day_off=ByteType(),
)
DIM_SECTOR = _struct(sector_key=_I, sector=_S)
BRIDGE_STOCK_INDEX = _struct(
    stock_key=_I, index_key=_L, effective_from=_DATE, effective_to=_DATE, is_current=ByteType(),
)
FACT_MARKET_EQUITY = _struct(
    stock_key=_I, date_key=_I, open=_D, high=_D, low=_D, close=_D, total_volume=_L,
    **{c: _D for c in INDICATOR_COLUMNS}, vwap=_D, **{c: _D for c in SUMMARY_METRICS},
)
FACT_MARKET_INDEX = _struct(
    index_key=_L, date_key=_I, open=_D, high=_D, low=_D, close=_D, total_volume=_L,
    **{c: _D for c in INDICATOR_COLUMNS},
)
FACT_STOCK_SIGNALS = _struct(stock_key=_I, date_key=_I, **{c: _S for c in STOCK_SIGNAL_COLUMNS})
FACT_INDEX_SIGNALS = _struct(index_key=_L, date_key=_I, **{c: _S for c in INDEX_SIGNAL_COLUMNS})
FACT_STOCK_EVENTS = _struct(
    stock_key=_I, public_date_key=_I, event_name_vi=_S, event_title_vi=_S, event_code=_S,
)
FACT_STOCK_NEWS = _struct(
    stock_key=_I, public_date_key=_I, news_title=_S, news_short_content=_S, news_image_url=_S,
    news_source_link=_S,
)
FACT_MARKET_SECTOR = _struct(
    sector_key=_I, date_key=_I, price_change_pct=_D, total_trade_value=_D, total_market_cap=_D,
    avg_pe=_D, avg_pb=_D, avg_eps=_D, stock_count=_I,
)

CANDLE_MESSAGE = _struct(
    received_at=_S, symbol=_S, resolution=_S, open=_D, high=_D, low=_D, close=_D, volume=_L,
    type=_S, time=_L, lastUpdated=_L,
)
TRADE_MESSAGE = _struct(
    received_at=_S, symbol=_S, price=_D, quantity=_L, total_volume=_L, board_id=ShortType(),
    market_id=ShortType(),
)
CANDLES = _struct(
    received_at=_TS, candle_time=_TS, symbol=_S, resolution=_S, market_type=_S, open=_D, high=_D,
    low=_D, close=_D, volume=_L, lastUpdated=_L,
)
TRADES = _struct(
    received_at=_TS, symbol=_S, price=_D, quantity=_L, total_volume=_L, board_id=ShortType(),
    market_id=ShortType(),
)
ALERTS = _struct(
    alert_time=_TS, symbol=_S, rule_name=_S, alert_type=_S, severity=_S, price=_D,
    indicator_value=_D, threshold=_D, deviation_pct=_D, message=_S,
)
LEGACY_ALERTS = _struct(
    alert_time=_TS, symbol=_S, alert_type=_S, price=_D, vwap=_D, deviation_pct=_D,
)

# Natural order of the replacing tables: the latest row per key wins.
REPLACING_KEYS = {
    "dim_stock": ["stock_key"],
    "dim_index": ["index_key"],
    "dim_date_event": ["date_key"],
    "dim_sector": ["sector_key"],
    "bridge_stock_index": ["stock_key", "index_key", "effective_from"],
    "fact_market_equity": ["stock_key", "date_key"],
    "fact_market_index": ["index_key", "date_key"],
    "fact_stock_signals": ["stock_key", "date_key"],
    "fact_index_signals": ["index_key", "date_key"],
    "fact_stock_events": ["stock_key", "public_date_key", "event_code", "event_title_vi"],
    "fact_stock_news": ["stock_key", "public_date_key", "news_title", "news_source_link"],
    "fact_market_sector": ["sector_key", "date_key"],
}
STAR_TABLES = {
    "dim_stock": DIM_STOCK,
    "dim_index": DIM_INDEX,
    "dim_date_event": DIM_DATE_EVENT,
    "dim_sector": DIM_SECTOR,
    "bridge_stock_index": BRIDGE_STOCK_INDEX,
    "fact_market_equity": FACT_MARKET_EQUITY,
    "fact_market_index": FACT_MARKET_INDEX,
    "fact_stock_signals": FACT_STOCK_SIGNALS,
    "fact_index_signals": FACT_INDEX_SIGNALS,
    "fact_stock_events": FACT_STOCK_EVENTS,
    "fact_stock_news": FACT_STOCK_NEWS,
    "fact_market_sector": FACT_MARKET_SECTOR,
}
