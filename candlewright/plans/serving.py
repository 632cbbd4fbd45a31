"""Served queries over the star schema and the stream tables.

Every parameter is bound as a literal; none becomes part of SQL text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright.operators.lookups import lookup_join, star_join
from candlewright.operators.latency import on_day
from candlewright.schemas import ALERT_COLUMNS, INDEX_SIGNAL_COLUMNS, STOCK_SIGNAL_COLUMNS


@dataclass
class Star:
    """The tables of the star schema."""

    dim_stock: DataFrame
    dim_date: DataFrame
    equity: DataFrame | None = None
    stock_signals: DataFrame | None = None
    dim_sector: DataFrame | None = None
    sector: DataFrame | None = None
    dim_index: DataFrame | None = None
    index: DataFrame | None = None
    index_signals: DataFrame | None = None
    events: DataFrame | None = None
    news: DataFrame | None = None

    @property
    def dates(self) -> DataFrame:
        return self.dim_date.select("date_key", "trade_date")


# Columns a screener may be sorted by.
SCREENER_SORTS = {
    "symbol", "close", "price_change_pct", "pe", "pb", "roe", "eps", "market_cap", "rsi_14",
    "dividend_yield", "beta",
}


def directed(column: str, order: str = "DESC") -> Column:
    """Sort column with nulls last in both directions."""
    c = F.col(column)
    return c.asc_nulls_last() if order.upper() == "ASC" else c.desc_nulls_last()


def total_of(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("total"))


MONTH = "trade_month"
_MONTH_FOLDER = re.compile(f"/{MONTH}=([0-9]{{4}}-[0-9]{{2}})/")


def months_of(fact: DataFrame) -> list[str]:
    """Months of a fact that is partitioned by them, newest first, from the names of its folders; none for other facts."""
    if MONTH not in fact.columns:
        return []
    return sorted({m for f in fact.inputFiles() for m in _MONTH_FOLDER.findall(f)}, reverse=True)


def _growing(months: Sequence[str]) -> Iterator[tuple[str, str]]:
    """(oldest, newest) of 1, 1, 2, 4, ... months in turn."""
    begin, size = 0, 1
    while begin < len(months):
        part = months[begin:begin + size]
        yield part[-1], part[0]
        begin, size = begin + size, max(1, begin + size)


def in_months(fact: DataFrame, oldest: str | None, newest: str | None) -> DataFrame:
    """Rows of a span of months: a partition filter."""
    if oldest:
        fact = fact.where(F.col(MONTH) >= oldest)
    return fact.where(F.col(MONTH) <= newest) if newest else fact


def latest_date_key(fact: DataFrame, dates: DataFrame) -> Column:
    """The last day of a fact that the calendar knows.

    Of a fact by months the newest month is asked first, in a small job of its own that reads one column of it; earlier
    months only while no known day was found. Of other facts it is a scalar subquery over all days.
    """
    def last(part: DataFrame) -> DataFrame:
        return part.select("date_key").distinct().join(dates.select("date_key"), "date_key", "left_semi").agg(F.max("date_key"))

    months = months_of(fact)
    if not months:
        return last(fact).scalar()
    for oldest, newest in _growing(months):
        found = last(in_months(fact, oldest, newest)).first()[0]
        if found is not None:
            return F.lit(found)
    return F.lit(None).cast(fact.schema["date_key"].dataType)


def on_day_key(fact: DataFrame, key: Column) -> DataFrame:
    """Rows of one day; of a fact by months only its month is read."""
    rows = fact.where(F.col("date_key") == key)
    if MONTH not in fact.columns:
        return rows
    year, month = (key.cast("int") / 10000).cast("int"), (key.cast("int") / 100).cast("int") % 100
    return rows.where(F.col(MONTH) == F.format_string("%04d-%02d", year, month))


def on_latest(fact: DataFrame, dates: DataFrame) -> DataFrame:
    return on_day_key(fact, latest_date_key(fact, dates))


def newest_part(fact: DataFrame, dates: DataFrame, limit: int, start: str | None, end: str | None) -> DataFrame:
    """So many of the newest months of a fact (by months) between two days that ``limit`` rows of known days lie in them.

    ``fact`` holds the rows of one key; counting takes small jobs over ever larger spans of months.
    """
    months = [m for m in months_of(fact) if (not start or m >= start[:7]) and (not end or m <= end[:7])]
    fact = in_months(fact, start[:7] if start else None, end[:7] if end else None)
    known, seen = dates.select("date_key", "trade_date"), 0
    for oldest, newest in _growing(months):
        rows = between_dates(in_months(fact, oldest, newest).select("date_key").join(known, "date_key"), start, end)
        seen += rows.limit(limit).count()
        if seen >= limit:
            return in_months(fact, oldest, None)
    return fact


def between_dates(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    if start:
        df = df.where(F.col("trade_date") >= F.lit(start).cast("date"))
    if end:
        df = df.where(F.col("trade_date") <= F.lit(end).cast("date"))
    return df


def contains_ignoring_case(column: str, text: str) -> Column:
    return F.contains(F.lower(F.col(column)), F.lit(text.lower()))


def stock_matches(
    star: Star, search: str | None = None, sector: str | None = None, exchange: str | None = None
) -> DataFrame:
    out = star.dim_stock
    if search:
        hit = F.lit(False)
        for column in ("symbol", "name", "organ_short_name"):
            hit = hit | F.coalesce(contains_ignoring_case(column, search), F.lit(False))
        out = out.where(hit)
    if sector:
        out = out.where(F.col("sector") == sector)
    if exchange:
        out = out.where(F.col("exchange") == exchange)
    return out


def stock_list(star: Star, limit: int = 100, offset: int = 0, **filters: str | None) -> DataFrame:
    columns = ["stock_key", "symbol", "name", "sector", "exchange", "organ_short_name", "organ_name",
               "listing_date", "issued_share", "profile"]
    return stock_matches(star, **filters).select(*columns).orderBy("symbol").offset(offset).limit(limit)


def stock_total(star: Star, **filters: str | None) -> DataFrame:
    return total_of(stock_matches(star, **filters))


def sector_names(star: Star) -> DataFrame:
    named = star.dim_stock.where(F.col("sector").isNotNull() & (F.col("sector") != ""))
    return named.select("sector").distinct().orderBy("sector")


def stock_detail(star: Star, symbol: str) -> DataFrame:
    return star.dim_stock.where(F.col("symbol") == symbol).limit(1)


def _key_of(dim: DataFrame, natural: str, value: str, key: str) -> Column:
    """The key of one dimension row as a literal, so that it reaches the scan of a sorted fact."""
    found = dim.where(F.col(natural) == value).select(key).first()
    return F.lit(None if found is None else found[0])


def _of_symbol(
    star: Star, fact: DataFrame, symbol: str, date_column: str = "date_key", limit: int = 0, start: str | None = None, end: str | None = None
) -> DataFrame:
    one = star.dim_stock.where(F.col("symbol") == symbol).select("stock_key", "symbol")
    if MONTH in fact.columns:
        fact = newest_part(fact.where(F.col("stock_key") == _key_of(star.dim_stock, "symbol", symbol, "stock_key")), star.dates, limit, start, end)
    dates = star.dates.withColumnRenamed("date_key", date_column)
    return star_join(fact, [(one, "stock_key"), (dates, date_column)])


def _newest(df: DataFrame, limit: int, *ties: str) -> DataFrame:
    return df.orderBy(F.col("trade_date").desc(), *ties).limit(limit)


def stock_history(
    star: Star, symbol: str, start: str | None = None, end: str | None = None, limit: int = 90
) -> DataFrame:
    columns = ["symbol", "trade_date", "open", "high", "low", "close", "total_volume", "price_change_pct",
               "sma_20", "sma_50", "ema_12", "ema_26", "rsi_14", "macd", "vwap", "pe", "pb", "roe", "eps",
               "bvps", "market_cap", "dividend_yield", "high_52w", "low_52w", "beta"]
    rows = between_dates(_of_symbol(star, star.equity, symbol, limit=limit, start=start, end=end), start, end)
    return _newest(rows.select(*columns), limit)


def signal_history(star: Star, symbol: str, limit: int = 30) -> DataFrame:
    rows = _of_symbol(star, star.stock_signals, symbol, limit=limit)
    return _newest(rows.select("symbol", "trade_date", *STOCK_SIGNAL_COLUMNS), limit)


def news_history(star: Star, symbol: str, limit: int = 20) -> DataFrame:
    columns = ["symbol", "trade_date", "news_title", "news_short_content", "news_image_url", "news_source_link"]
    rows = _of_symbol(star, star.news, symbol, "public_date_key")
    return _newest(rows.select(*columns), limit, "news_title", "news_source_link")


def event_history(star: Star, symbol: str, limit: int = 20) -> DataFrame:
    columns = ["symbol", "trade_date", "event_name_vi", "event_title_vi", "event_code"]
    rows = _of_symbol(star, star.events, symbol, "public_date_key")
    return _newest(rows.select(*columns), limit, "event_title_vi", "event_name_vi", "event_code")


def screener_matches(
    star: Star,
    sector: str | None = None,
    exchange: str | None = None,
    signal: str | None = None,
    ranges: dict[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Latest facts that satisfy every filter; ``ranges`` maps a measure to inclusive bounds."""
    signals = star.stock_signals  # asked for first: what a star shuffles for its signals is gone before it writes the wide facts
    latest = latest_date_key(star.equity, star.dates)
    facts = on_day_key(star.equity, latest)
    for measure, (low, high) in (ranges or {}).items():
        if low is not None:
            facts = facts.where(F.col(measure) >= F.lit(low))
        if high is not None:
            facts = facts.where(F.col(measure) <= F.lit(high))
    stocks = star.dim_stock.select("stock_key", "symbol", "organ_short_name", "sector", "exchange")
    if sector:
        stocks = stocks.where(F.col("sector") == sector)
    if exchange:
        stocks = stocks.where(F.col("exchange") == exchange)
    labels = on_day_key(signals, latest).select("stock_key", "date_key", "label_stock_class", "label_trading_action")
    out = star_join(facts, [(stocks, "stock_key"), (star.dates, "date_key")], labels, ["stock_key", "date_key"])
    return out.where(contains_ignoring_case("label_trading_action", signal)) if signal else out


def screener(
    star: Star, sort_by: str = "market_cap", sort_order: str = "DESC", limit: int = 50, offset: int = 0, **filters
) -> DataFrame:
    """One page of the screener; an unknown sort falls back to descending market cap."""
    column = sort_by if sort_by in SCREENER_SORTS else "market_cap"
    order = sort_order if sort_order.upper() in ("ASC", "DESC") else "DESC"
    columns = ["symbol", "organ_short_name", "sector", "exchange", "trade_date", "close", "price_change_pct",
               "pe", "pb", "roe", "eps", "market_cap", "dividend_yield", "rsi_14", "macd", "beta", "high_52w",
               "low_52w", "label_stock_class", "label_trading_action"]
    rows = screener_matches(star, **filters).select(*columns)
    return rows.orderBy(directed(column, order), "symbol").offset(offset).limit(limit)


def screener_total(star: Star, **filters) -> DataFrame:
    return total_of(screener_matches(star, **filters))


def indices_latest(star: Star) -> DataFrame:
    latest = latest_date_key(star.index, star.dates)
    rows = star_join(
        on_day_key(star.index, latest),
        [(star.dim_index.select("index_key", "index_symbol", "index_name"), "index_key"), (star.dates, "date_key")],
        on_day_key(star.index_signals, latest).drop(MONTH), ["index_key", "date_key"],
    )
    return rows.select(
        "index_symbol", "index_name", "trade_date", "open", "high", "low", "close", "price_change_pct",
        "total_volume", "sma_20", "sma_50", "rsi_14", "macd", *INDEX_SIGNAL_COLUMNS,
    ).orderBy("index_symbol")


def index_history(
    star: Star, symbol: str, start: str | None = None, end: str | None = None, limit: int = 90
) -> DataFrame:
    one = star.dim_index.where(F.col("index_symbol") == symbol).select("index_key", F.col("index_symbol").alias("symbol"))
    facts, signals = star.index, star.index_signals
    if MONTH in facts.columns:
        key = _key_of(star.dim_index, "index_symbol", symbol, "index_key")
        facts = newest_part(facts.where(F.col("index_key") == key), star.dates, limit, start, end)
    if MONTH in facts.columns and MONTH in signals.columns:  # the same folders on both sides
        rows = star_join(facts, [(one, "index_key"), (star.dates, "date_key")], signals.where(F.col("index_key") == key), ["index_key", "date_key", MONTH])
    else:
        rows = star_join(facts, [(one, "index_key"), (star.dates, "date_key")], signals.drop(MONTH), ["index_key", "date_key"])
    columns = ["symbol", "trade_date", "open", "high", "low", "close", "total_volume", "price_change_pct",
               "sma_20", "sma_50", "ema_12", "ema_26", "rsi_14", "macd", *INDEX_SIGNAL_COLUMNS]
    return _newest(between_dates(rows, start, end).select(*columns), limit)


def top_movers(star: Star, gainers: bool = True, limit: int = 10) -> DataFrame:
    facts = on_latest(star.equity, star.dates).where(F.col("price_change_pct").isNotNull())
    stocks = star.dim_stock.select("stock_key", "symbol")
    rows = star_join(facts, [(stocks, "stock_key"), (star.dates, "date_key")])
    return rows.select("symbol", "close", "price_change_pct").orderBy(
        directed("price_change_pct", "DESC" if gainers else "ASC"), "symbol"
    ).limit(limit)


def top_sectors(star: Star, gainers: bool = True, limit: int = 5) -> DataFrame:
    facts = on_latest(star.sector, star.dates).where(F.col("price_change_pct").isNotNull())
    rows = star_join(facts, [(star.dim_sector, "sector_key"), (star.dates, "date_key")])
    return rows.select("sector", "price_change_pct", "total_market_cap", "total_trade_value").orderBy(
        directed("price_change_pct", "DESC" if gainers else "ASC"), "sector"
    ).limit(limit)


def month_calendar(star: Star, year: int, month: int) -> DataFrame:
    """Days of a month that have a name or are off."""
    named = F.coalesce(F.col("event_name") != "", F.lit(False))
    return star.dim_date.where(
        (F.col("cal_year") == year) & (F.col("cal_month") == month) & (named | (F.col("is_day_off") == 1))
    ).select("trade_date", "event_name", "is_day_off").orderBy("trade_date")


_SECTOR_MEASURES = ["price_change_pct", "total_trade_value", "total_market_cap", "avg_pe", "avg_pb",
                    "avg_eps", "stock_count"]


def sectors_latest(star: Star) -> DataFrame:
    rows = star_join(on_latest(star.sector, star.dates), [(star.dim_sector, "sector_key"), (star.dates, "date_key")])
    return rows.select("sector_key", "sector", "trade_date", *_SECTOR_MEASURES).orderBy(
        directed("total_market_cap"), "sector_key"
    )


def sector_detail(star: Star, sector_key: int) -> DataFrame:
    """The sector's own latest row."""
    own = star.sector.where(F.col("sector_key") == sector_key)
    rows = star_join(on_latest(own, star.dates), [(star.dim_sector, "sector_key"), (star.dates, "date_key")])
    return rows.select("sector_key", "sector", "trade_date", *_SECTOR_MEASURES).limit(1)


def sector_details(star: Star) -> DataFrame:
    """Every sector's own latest row in one pass."""
    known = lookup_join(star.sector, star.dates, ["date_key"], "inner")
    last = known.groupBy("sector_key").agg(F.max("date_key").alias("date_key"))
    rows = lookup_join(known.join(last, ["sector_key", "date_key"]), star.dim_sector, ["sector_key"], "inner")
    return rows.select("sector_key", "sector", "trade_date", *_SECTOR_MEASURES)


def sector_top_stocks(star: Star, sector_key: int, limit: int = 15) -> DataFrame:
    name = star.dim_sector.where(F.col("sector_key") == sector_key).limit(1).select("sector").scalar()
    stocks = star.dim_stock.where(F.col("sector") == name).select("stock_key", "symbol", "organ_short_name")
    rows = star_join(on_latest(star.equity, star.dates), [(stocks, "stock_key"), (star.dates, "date_key")])
    return rows.select(
        "symbol", "organ_short_name", "trade_date", "close", "price_change_pct", "market_cap", "pe", "pb", "eps"
    ).orderBy(directed("market_cap"), "symbol").limit(limit)


def sector_history(
    star: Star, sector_key: int, start: str | None = None, end: str | None = None, limit: int = 90
) -> DataFrame:
    one = star.dim_sector.where(F.col("sector_key") == sector_key).select("sector_key", F.col("sector").alias("sector_name"))
    facts = star.sector.where(F.col("sector_key") == sector_key)
    if MONTH in facts.columns:
        facts = newest_part(facts, star.dates, limit, start, end)
    rows = star_join(facts, [(one, "sector_key"), (star.dates, "date_key")])
    return _newest(between_dates(rows, start, end).select("sector_name", "trade_date", *_SECTOR_MEASURES), limit)


def sector_table(sectors: DataFrame, sort_by: str, order: str = "DESC") -> DataFrame:
    """Sectors sorted by a chosen column; a missing value counts as 0."""
    value = F.coalesce(F.col(sort_by), F.lit(0))
    return sectors.orderBy(value.asc() if order.upper() == "ASC" else value.desc(), "sector_key")


def alerts_of_day(
    alerts: DataFrame, day: str, symbol: str | None = None, rule: str = "ALL", severity: str | None = None,
    limit: int = 50,
) -> DataFrame:
    rows = on_day(alerts, "alert_time", day)
    if symbol:
        rows = rows.where(F.col("symbol") == symbol)
    if rule != "ALL":
        rows = rows.where(F.col("rule_name") == rule)
    if severity:
        rows = rows.where(F.col("severity") == severity)
    return rows.select(*ALERT_COLUMNS).orderBy(F.col("alert_time").desc(), "symbol", "alert_type").limit(limit)


def last_price(candles: DataFrame, symbol: str, day: str) -> DataFrame:
    """Last close of a symbol on a day."""
    rows = on_day(candles.where(F.col("symbol") == symbol), "candle_time", day)
    return rows.agg(
        F.max_by("close", "candle_time").alias("close"), F.max("candle_time").alias("candle_time")
    ).where(F.col("candle_time").isNotNull())


def last_prices(candles: DataFrame) -> DataFrame:
    """Last close per symbol and day."""
    return candles.groupBy("symbol", F.to_date("candle_time").alias("day")).agg(
        F.max_by("close", "candle_time").alias("close"), F.max("candle_time").alias("candle_time")
    )
