"""Stage and star tables over the given data, published once per session and folder.

They lie in the shared checkpoint folder; later queries read them as a server would read its tables.
"""

from __future__ import annotations

import hashlib
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright import schemas
from candlewright.operators import dims, lookups
from candlewright.operators.sector import sector_daily
from candlewright.plans import daily, flows
from candlewright.plans.serving import Star
from candlewright.session import ensure_checkpoint_dir
from candlewright.sources.writers import Store, align_to_schema
from workbench import mapping as M

_STAGES: dict[tuple[str, str], "Stage"] = {}


def scratch(spark: SparkSession, *parts: str) -> str:
    """A folder of our own below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return "/".join([spark.sparkContext.getCheckpointDir().rstrip("/"), "tables", *parts])


class StagedStar(Star):
    """A star of which each table is published when it is first asked for: a query builds what it reads, and no other table."""

    def __init__(self, stage: "Stage", **tables: str):
        self._stage, self._tables = stage, tables

    def __getattribute__(self, name: str):
        tables = object.__getattribute__(self, "__dict__").get("_tables", {})
        return getattr(self._stage, tables[name]) if name in tables else object.__getattribute__(self, name)


class Stage:
    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d
        self.store = Store(spark, scratch(spark, hashlib.sha1(d.encode()).hexdigest()[:12]))

    def _publish(self, name: str, df: DataFrame) -> DataFrame:
        return self.store.publish(df, name)

    def _publish_months(self, name: str, df: DataFrame, key: str, spread: bool = True) -> DataFrame:
        return daily.by_month(self.store, df, name, None, key, "date_key", spread)

    @cached_property
    def bars(self) -> DataFrame:
        return self._publish("stage_1.fact_market_equity", M.bars(self.spark, self.d))

    @cached_property
    def summary(self) -> DataFrame:
        return self._publish("stage_1.fact_equity_summary", M.summary(self.spark, self.d))

    @cached_property
    def equity(self) -> DataFrame:
        return self._publish("stage_2.fact_market_equity", flows.equity_indicators(self.bars, self.summary, ranged=True))

    @cached_property
    def signals(self) -> DataFrame:
        return self._publish("stage_2.fact_stock_signals", flows.stock_signals(self.equity.repartitionByRange("symbol"), self.dim_stock))

    @cached_property
    def index(self) -> DataFrame:
        return self._publish("stage_2.fact_market_index", flows.index_indicators(M.index_bars(self.spark, self.d)))

    @cached_property
    def index_signals(self) -> DataFrame:
        return self._publish("stage_2.fact_index_signals", flows.index_signals(self.index))

    @cached_property
    def dim_stock(self) -> DataFrame:
        none = self.spark.createDataFrame([], "symbol string, stock_key int")
        keyed, _ = dims.assign_surrogate_keys(M.instruments(self.spark, self.d), none)
        return self._publish("master.dim_stock", align_to_schema(keyed, schemas.DIM_STOCK))

    @cached_property
    def dim_sector(self) -> DataFrame:
        clean = dims.clean_sector_info(M.sector_info(self.spark, self.d))
        return self._publish("master.dim_sector", dims.surrogate_from_source(clean, "sector_id", "sector_key"))

    @cached_property
    def dim_index(self) -> DataFrame:
        clean = dims.clean_index_info(M.index_info(self.spark, self.d))
        return self._publish("master.dim_index", dims.surrogate_from_source(clean, "index_id", "index_key", "bigint"))

    @cached_property
    def dim_date(self) -> DataFrame:
        """Every day that orders, prints or published figures mention."""
        traded = self.bars.select(F.col("trade_date").alias("date")).distinct()
        ordered = M.calendar(self.spark, self.d).select("date")
        days = dims.calendar_days(traded.unionByName(ordered).distinct()).withColumnRenamed("cal_week", "week")
        return self._publish("master.dim_date_event", dims.publish_calendar(days, M.market_events(self.spark, self.d)))

    @cached_property
    def fact_equity(self) -> DataFrame:
        return self._publish_months("master.fact_market_equity", lookups.resolve_fact_keys(self.equity, self.dim_stock, "stock_key"), "stock_key", spread=False)

    @cached_property
    def fact_signals(self) -> DataFrame:
        return self._publish_months("master.fact_stock_signals", lookups.resolve_fact_keys(self.signals, self.dim_stock, "stock_key"), "stock_key", spread=False)

    @cached_property
    def fact_index(self) -> DataFrame:
        return self._publish_months("master.fact_market_index", lookups.resolve_fact_keys(
            self.index, self.dim_index, "index_key", dim_natural="index_symbol", on_orphan="keep"), "index_key")

    @cached_property
    def fact_index_signals(self) -> DataFrame:
        return self._publish_months("master.fact_index_signals", lookups.resolve_fact_keys(
            self.index_signals, self.dim_index, "index_key", dim_natural="index_symbol", on_orphan="keep"), "index_key")

    @cached_property
    def fact_sector(self) -> DataFrame:
        return self._publish_months("master.fact_market_sector", sector_daily(self.fact_equity, self.dim_stock, self.dim_sector), "sector_key")

    @cached_property
    def company_stocks(self) -> DataFrame:
        return M.customers_as_stocks(self.spark, self.d)

    @cached_property
    def fact_events(self) -> DataFrame:
        clean = dims.clean_company_items(M.raw_company_events(self.spark, self.d), schemas.EVENT_COLUMNS, "ticker")
        return self._publish("master.fact_stock_events", lookups.resolve_fact_keys(
            clean, self.company_stocks, "stock_key", date_column="public_date", date_name="public_date_key"))

    @cached_property
    def fact_news(self) -> DataFrame:
        clean = dims.clean_company_items(M.raw_company_news(self.spark, self.d), schemas.NEWS_COLUMNS)
        return self._publish("master.fact_stock_news", lookups.resolve_fact_keys(
            clean, self.company_stocks, "stock_key", date_column="public_date", date_name="public_date_key"))

    @cached_property
    def star(self) -> Star:
        return StagedStar(
            self, dim_stock="dim_stock", dim_date="dim_date", equity="fact_equity", stock_signals="fact_signals",
            dim_sector="dim_sector", sector="fact_sector",
        )

    @cached_property
    def index_star(self) -> Star:
        return StagedStar(
            self, dim_stock="dim_stock", dim_date="dim_date", dim_index="dim_index", index="fact_index",
            index_signals="fact_index_signals",
        )

    @cached_property
    def company_star(self) -> Star:
        return StagedStar(self, dim_stock="company_stocks", dim_date="dim_date", events="fact_events", news="fact_news")


def stage(spark: SparkSession, d: str) -> Stage:
    key = (spark.sparkContext.applicationId, d)
    if key not in _STAGES:
        _STAGES[key] = Stage(spark, d)
    return _STAGES[key]
