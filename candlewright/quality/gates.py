"""The checks every published table must pass."""

from candlewright.schemas import BAR_COLUMNS


def _present(*columns):
    return ("columns_not_null", {"columns": list(columns)})


def _unique(*columns):
    if len(columns) == 1:
        return ("column_values_unique", {"column": columns[0]})
    return ("compound_columns_unique", {"column_list": list(columns)})


_FILLED = ("table_row_count_between", {"min_value": 1})
_HIGH_LOW = ("column_a_greater_than_b", {"column_a": "high", "column_b": "low", "or_equal": True})

GATES = {
    "stage_1.fact_market_equity": [
        ("columns_to_match_set", {"column_set": BAR_COLUMNS}), _present("symbol", "trade_date"), _FILLED],
    "stage_1.fact_market_index": [_present("symbol", "trade_date"), _unique("symbol", "trade_date"), _FILLED],
    "stage_1.fact_equity_summary": [_present("symbol", "trade_date"), _FILLED],
    "stage_1.fact_stock_events": [_present("symbol", "event_code"), _FILLED],
    "stage_1.fact_stock_news": [_present("symbol"), _FILLED],
    "stage_1.dim_sector_info": [_present("sector_id", "sector"), _unique("sector_id"), _FILLED],
    "stage_1.dim_stock_info": [_present("symbol"), _unique("symbol"), _FILLED],
    "stage_1.dim_index_info": [_present("index_id"), _FILLED],
    "stage_1.bridge_stock_index": [_unique("symbol", "index_id"), _present("symbol", "index_id"), _FILLED],
    "stage_2.fact_market_equity": [
        _HIGH_LOW,
        ("column_values_between", {"column": "close", "min_value": 0, "max_value": 10_000_000, "strict_min": True}),
        ("column_values_between", {"column": "total_volume", "min_value": 0, "max_value": 1e12}),
        ("column_values_between", {"column": "rsi_14", "min_value": 0, "max_value": 100}),
        _unique("symbol", "trade_date"), _present("symbol", "trade_date", "close"), _FILLED],
    "stage_2.fact_market_index": [
        _HIGH_LOW, _unique("symbol", "trade_date"), _present("symbol", "trade_date", "close"), _FILLED],
    "stage_2.fact_stock_signals": [_unique("symbol", "trade_date"), _present("symbol", "trade_date"), _FILLED],
    "stage_2.fact_index_signals": [_unique("symbol", "trade_date"), _present("symbol", "trade_date"), _FILLED],
    "stage_2.fact_stock_events": [_present("symbol", "public_date", "event_code"), _FILLED],
    "stage_2.fact_stock_news": [_present("symbol", "public_date", "news_title"), _FILLED],
    "stage_2.dim_date_event": [_present("trade_date"), _unique("trade_date"), _FILLED],
    "stage_2.dim_stock_info": [_present("symbol"), _unique("symbol"), _FILLED],
    "stage_2.dim_index_info": [_present("index_id", "index_symbol"), _unique("index_id"), _FILLED],
    "stage_2.dim_sector_info": [_present("sector_id", "sector"), _unique("sector_id"), _FILLED],
    "stage_2.bridge_stock_index": [
        _present("symbol", "index_id", "effective_from", "effective_to", "is_current"), _FILLED],
    "stage_2.bridge_stock_index.open": [_unique("symbol", "index_id")],
    "master.dim_stock": [_present("stock_key"), _unique("stock_key"), _unique("symbol"), _FILLED],
    "master.dim_index": [_present("index_key"), _unique("index_key"), _FILLED],
    "master.dim_sector": [_present("sector_key", "sector"), _unique("sector_key"), _FILLED],
    "master.dim_date_event": [_present("date_key"), _unique("date_key"), _FILLED],
    "master.bridge_stock_index": [_present("stock_key", "index_key"), _FILLED],
    "master.fact_market_equity": [_present("stock_key", "date_key"), _unique("stock_key", "date_key"), _FILLED],
    "master.fact_market_index": [_present("index_key", "date_key"), _unique("index_key", "date_key"), _FILLED],
    "master.fact_stock_signals": [_present("stock_key", "date_key"), _unique("stock_key", "date_key"), _FILLED],
    "master.fact_index_signals": [_present("index_key", "date_key"), _unique("index_key", "date_key"), _FILLED],
    "master.fact_stock_events": [_present("stock_key", "public_date_key"), _FILLED],
    "master.fact_stock_news": [_present("stock_key", "public_date_key"), _FILLED],
    "master.fact_market_sector": [_present("sector_key", "date_key"), _unique("sector_key", "date_key"), _FILLED],
}
