"""The daily jobs. Each step is published behind its gate and read back by the next.

Stage 1 is merged day by day, touching only the months of the new rows. Indicators go on from the state that the symbols
had at the end of an earlier month, so a daily run reads the bars of its own month; a backfill goes back to the newest
state before its first day.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewright import schemas
from candlewright.functions.cleanse import conform
from candlewright.operators import carry, dims, lookups
from candlewright.operators.bars import daily_bars
from candlewright.operators.carry import month_of
from candlewright.operators.sector import sector_daily
from candlewright.plans import flows
from candlewright.quality.gates import GATES
from candlewright.quality.suite import gate
from candlewright.session import pinned
from candlewright.sources import lifecycle
from candlewright.sources.files import delete, exists
from candlewright.sources.writers import Store, align_to_schema, append_merge

_KEY = ["symbol", "trade_date"]


def merge_stage(store: Store, name: str, rows: DataFrame) -> list[str]:
    """Check new daily rows and merge them into a stage 1 table, the new row winning; returns the months they touch.

    The rows are written aside first, once: what they are made of is read once. A month follows from its day and is part of the key,
    so that one shuffle serves the merge and the months.
    """
    month = rows.withColumn("trade_month", month_of("trade_date"))
    written, staged = store.aside(month, name)
    try:
        gate(written.drop("trade_month"), GATES[name], name)
        append_merge(written, store.path(name), [*_KEY, "trade_month"], ["trade_month"], staged=True)
        return sorted(r[0] for r in written.select("trade_month").distinct().collect())
    finally:
        delete(store.spark, staged)


def _since(store: Store, name: str, month: str | None) -> DataFrame:
    """A table by months, those after ``month`` only; the folders of earlier ones are not opened."""
    table = store.read(name)
    kept = table if month is None else table.where(F.col("trade_month") > month)
    return kept.drop("trade_month")


def _begin(store: Store, name: str, touched: list[str], rebuild: bool) -> tuple[str | None, str | None]:
    """(first month to publish anew, month of the state to go on from); both None for everything.

    A run that didn't come to its end left a mark: its months are done again. Without new rows nothing is left to do.
    """
    had = store.partitions(f"{name}_state", "state_month")
    first = "" if rebuild or not had else min(touched + [m.removeprefix("m") for m in store.marks(name)], default="9999-12")
    store.mark(name, f"m{first}")
    return first or None, max((m for m in had if m < first), default=None)


def _state(store: Store, name: str, month: str | None) -> DataFrame | None:
    return None if month is None else store.read(f"{name}_state").where(F.col("state_month") == month).drop("state_month")


def _publish_states(store: Store, name: str, rows: DataFrame, base: str | None) -> None:
    """The states of the months of ``rows``, and none other after ``base``: older ones would no longer hold."""
    months = carry.kept_months([r[0] for r in rows.select(month_of("trade_date")).distinct().collect()])
    if not months:
        return
    for month in store.partitions(f"{name}_state", "state_month"):
        if month not in months and month > (base or ""):
            delete(store.spark, f"{store.path(name)}_state/state_month={month}")
    store.publish_parts(carry.states(rows, _state(store, name, base), months), f"{name}_state", "state_month", ["symbol"], checks=[], spread=False)


def by_month(store: Store, df: DataFrame, name: str, first: str | None, key: str, day: str, spread: bool = True) -> DataFrame:
    """Publish a table by months from ``first`` on; without ``spread`` from rows that lie by months already."""
    month = month_of(day) if day == "trade_date" else F.format_string("%04d-%02d", (F.col(day) / 10000).cast("int"), (F.col(day) / 100).cast("int") % 100)
    dated = df.withColumn("trade_month", month)
    return store.publish_parts(dated if first is None else dated.where(F.col("trade_month") >= first), name, "trade_month", [key, day], spread=spread)


def equity_daily(
    store: Store, prints: DataFrame, raw_summary: DataFrame | None = None, order: str | Column = "time", name_bars=None, rebuild: bool = False
) -> dict[str, DataFrame]:
    """Prints and fundamentals of any days to indicators, signals, star facts and sectors.

    ``name_bars`` may attach symbols to bars that were reduced by another key. Needs the published
    stock and sector dimensions. Months from the first touched one on are calculated anew, going on from the state of
    the symbols before them; earlier months stay as they were published, also where a dimension changed since
    (``rebuild`` does all months from the first bar).
    """
    fresh = daily_bars(prints, order)
    bars_name, summary_name, name = "stage_1.fact_market_equity", "stage_1.fact_equity_summary", "stage_2.fact_market_equity"
    touched = merge_stage(store, bars_name, fresh if name_bars is None else name_bars(fresh))
    if raw_summary is not None:
        touched = touched + merge_stage(store, summary_name, flows.clean_summary(raw_summary))
    first, base = _begin(store, name, touched, rebuild)
    bars, state = _since(store, bars_name, base), _state(store, name, base)
    summary = _since(store, summary_name, base) if store.has(summary_name) else None
    stocks, sectors = store.read("master.dim_stock"), store.read("master.dim_sector")
    rows = pinned(flows.continued_equity(bars, summary, state))
    equity = by_month(store, rows.select(*schemas.EQUITY_COLUMNS), name, first, "symbol", "trade_date")
    signals = by_month(store, flows.signals_of(rows, stocks), "stage_2.fact_stock_signals", first, "symbol", "trade_date")
    new = lambda df: (df if first is None else df.where(F.col("trade_month") >= first)).drop("trade_month")
    fact = by_month(store, lookups.resolve_fact_keys(new(equity), stocks, "stock_key"), "master.fact_market_equity", first, "stock_key", "date_key", spread=False)
    labels = by_month(store, lookups.resolve_fact_keys(new(signals), stocks, "stock_key"), "master.fact_stock_signals", first, "stock_key", "date_key", spread=False)
    by_sector = by_month(store, sector_daily(new(fact), stocks, sectors), "master.fact_market_sector", first, "sector_key", "date_key")
    _publish_states(store, name, rows, base)
    store.unmark(name)
    return {"equity": fact, "signals": labels, "sector": by_sector}


def equity_backfill(
    store: Store, prints: DataFrame, raw_summary: DataFrame | None, run_date: date, days: int = 7,
    order: str | Column = "time", name_bars=None, date_column: str = "time",
) -> dict[str, DataFrame]:
    """Merge the ``days`` days before ``run_date`` again, all at once, then rebuild once."""
    first, last = F.lit(run_date - timedelta(days=days)), F.lit(run_date - timedelta(days=1))
    some = prints.where(F.to_date(date_column).between(first, last))
    figures = None if raw_summary is None else raw_summary.where(F.to_date("date").between(first, last))
    return equity_daily(store, some, figures, order, name_bars)


def index_daily(store: Store, prints: DataFrame, order: str | Column = "time", rebuild: bool = False) -> dict[str, DataFrame]:
    """As ``equity_daily``, for indices."""
    bars_name, name = "stage_1.fact_market_index", "stage_2.fact_market_index"
    first, base = _begin(store, name, merge_stage(store, bars_name, daily_bars(prints, order)), rebuild)
    state = _state(store, name, base)
    rows = pinned(carry.continued_indicators(_since(store, bars_name, base), state, include_vwap=False))
    index = by_month(store, rows.select(*schemas.INDEX_COLUMNS), name, first, "symbol", "trade_date")
    new = (index if first is None else index.where(F.col("trade_month") >= first)).drop("trade_month")
    signals = by_month(store, flows.index_signals(new), "stage_2.fact_index_signals", first, "symbol", "trade_date")
    new_signals = (signals if first is None else signals.where(F.col("trade_month") >= first)).drop("trade_month")
    indices = store.read("master.dim_index")
    keyed = {"dim_natural": "index_symbol", "on_orphan": "keep"}
    fact = by_month(store, lookups.resolve_fact_keys(new, indices, "index_key", **keyed), "master.fact_market_index", first, "index_key", "date_key", spread=False)
    labels = by_month(store, lookups.resolve_fact_keys(new_signals, indices, "index_key", **keyed), "master.fact_index_signals", first, "index_key", "date_key", spread=False)
    _publish_states(store, name, rows, base)
    store.unmark(name)
    return {"index": fact, "signals": labels}


def dimensions(
    store: Store, company_info: DataFrame, listing: DataFrame, index_info: DataFrame, sector_info: DataFrame,
    calendar: DataFrame, market_events: DataFrame, members: DataFrame, run_date: date, composite: str = "VNINDEX",
) -> dict[str, DataFrame]:
    """All dimensions and the membership bridge; keys already given are kept."""
    spark = store.spark
    info = store.publish(lookups.join_new_columns(company_info, listing), "stage_1.dim_stock_info")
    mapping = store.read("master.stock_key_map") if store.has("master.stock_key_map") else spark.createDataFrame(
        [], "symbol string, stock_key int")
    keyed, updated = dims.assign_surrogate_keys(info, mapping)
    stocks = store.publish(align_to_schema(keyed, schemas.DIM_STOCK), "master.dim_stock")
    store.publish(updated, "master.stock_key_map", checks=[("column_values_unique", {"column": "stock_key"})])
    index_rows = store.publish(dims.clean_index_info(index_info), "stage_1.dim_index_info")
    indices = store.publish(dims.surrogate_from_source(index_rows, "index_id", "index_key", "bigint"), "master.dim_index")
    sector_rows = store.publish(dims.clean_sector_info(sector_info), "stage_1.dim_sector_info")
    sectors = store.publish(dims.surrogate_from_source(sector_rows, "sector_id", "sector_key"), "master.dim_sector")
    days = store.publish(dims.publish_calendar(calendar, market_events), "master.dim_date_event")
    snapshot = store.publish(
        lookups.membership_snapshot(listing, index_info, members, composite), "stage_1.bridge_stock_index")
    history = store.read("stage_2.bridge_stock_index") if store.has("stage_2.bridge_stock_index") else None
    merged = dims.merge_memberships(history, snapshot, run_date)
    gate(merged.where("is_current = 1"), GATES["stage_2.bridge_stock_index.open"], "open memberships")
    bridge = store.publish(merged, "stage_2.bridge_stock_index")
    keyed_bridge = store.publish(lookups.resolve_bridge(bridge, stocks, indices), "master.bridge_stock_index")
    return {"dim_stock": stocks, "dim_index": indices, "dim_sector": sectors, "dim_date": days, "bridge": keyed_bridge}


def company_items(store: Store, raw_events: DataFrame, raw_news: DataFrame, stocks: DataFrame) -> dict[str, DataFrame]:
    """Company events and news to star facts; items without a publication date are left out."""
    out = {}
    for name, raw, columns, symbol in (
        ("fact_stock_events", raw_events, schemas.EVENT_COLUMNS, "ticker"),
        ("fact_stock_news", raw_news, schemas.NEWS_COLUMNS, "symbol"),
    ):
        clean = store.publish(dims.clean_company_items(raw, columns, symbol), f"stage_1.{name}")
        tidy = store.publish(conform(clean, columns, not_null=["symbol", "public_date"]), f"stage_2.{name}")
        out[name] = store.publish(lookups.resolve_fact_keys(
            tidy, stocks, "stock_key", date_column="public_date", date_name="public_date_key"), f"master.{name}")
    return out


def archive_then_purge(
    table_path: str, spark, column: str, archive_root: str, day: str, today: date, retention_days: int = 30
) -> dict:
    """Archive one day of a table partitioned by date, then drop its archived days past the retention."""
    status = {}
    if exists(spark, table_path):
        table = spark.read.parquet(table_path)
        status["archived"] = {r["date"]: r["status"] for r in lifecycle.archive(table, column, archive_root, day).collect()}
        status["purged"] = lifecycle.purge_partitions(spark, table_path, archive_root, today, retention_days)
    return status
