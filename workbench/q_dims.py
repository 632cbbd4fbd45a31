"""Joins and dimensions."""

from datetime import date

from pyspark.sql import functions as F

from candlewright import schemas
from candlewright.operators import dims, lookups
from candlewright.operators.sector import with_sector
from workbench import mapping as M
from workbench import sqlparts as S
from workbench.catalog import query, r, rounded
from workbench.q_tables import FANOUT, INDEX_DIM
from workbench.stage import stage


@query("jon_1_bars_with_summary", f"""WITH {S.EQUITY} SELECT symbol, trade_date, close, {r(4, 'market_cap', 'eps', 'roe')} FROM equity""")
def _(spark, d):
    s = stage(spark, d)
    out = lookups.join_summary(s.bars, s.summary).select("symbol", "trade_date", "close", "market_cap", "eps", "roe")
    return rounded(out, 4, "market_cap", "eps", "roe")


@query("jon_2_new_columns_only", f"WITH {S.EQUITY} SELECT symbol, name, sector, exchange, type FROM stocks")
def _(spark, d):
    base = M.instruments(spark, d)
    info = base.select("symbol", "name", "sector")
    listing = base.select("symbol", F.lit("other").alias("name"), "exchange", "type")
    return lookups.join_new_columns(info, listing)


@query("jon_3_calendar_fan_out", f"WITH {FANOUT} SELECT date, event_name, event_type FROM joined")
def _(spark, d):
    return dims.join_calendar_events(M.calendar(spark, d), M.market_events(spark, d)).select("date", "event_name", "event_type")


KNOWN = S.EQUITY + ", known AS (SELECT symbol, stock_key FROM stocks WHERE sid % 5 <> 0)"
FACT = f"SELECT k.stock_key, {S.DATE_KEY.format(c='trade_date')} AS date_key, close, total_volume FROM equity e {{join}} known k ON k.symbol = e.symbol"


def _partial(spark, d):
    s = stage(spark, d)
    known = s.dim_stock.join(M.instruments(spark, d).where("sid % 5 <> 0").select("symbol"), "symbol", "left_semi")
    return s.equity.select("symbol", "trade_date", "close", "total_volume"), known


@query("jon_4_resolve_keys", f"WITH {KNOWN} {FACT.format(join='JOIN')}")
def _(spark, d):
    facts, known = _partial(spark, d)
    return lookups.resolve_fact_keys(facts, known, "stock_key")


@query("jon_4_resolve_keys_salted", f"WITH {KNOWN} {FACT.format(join='JOIN')}")
def _(spark, d):
    """The same with the size limit at zero, which takes the way of a large dimension."""
    facts, known = _partial(spark, d)
    return lookups.resolve_fact_keys(facts, known, "stock_key", broadcast_bytes=0)


@query("jon_4_orphan_report", f"""WITH {KNOWN} SELECT symbol, count(*) AS fact_rows FROM equity
WHERE symbol NOT IN (SELECT symbol FROM known) GROUP BY 1""")
def _(spark, d):
    facts, known = _partial(spark, d)
    return lookups.orphan_report(facts, known, "symbol")


@query("jon_4_orphan_sample", f"""WITH {KNOWN} SELECT symbol, count(*) AS fact_rows FROM equity
WHERE symbol NOT IN (SELECT symbol FROM known) GROUP BY 1 ORDER BY symbol LIMIT 10""")
def _(spark, d):
    facts, known = _partial(spark, d)
    return lookups.orphan_sample(facts, known, "symbol")


@query("jon_5_keep_orphans", f"WITH {KNOWN} {FACT.format(join='LEFT JOIN')}")
def _(spark, d):
    facts, known = _partial(spark, d)
    return lookups.resolve_fact_keys(facts, known, "stock_key", on_orphan="keep")


@query("jon_6_bridge_keys", """SELECT CAST(c_custkey + 1 AS INTEGER) AS stock_key, CAST(c_nationkey AS BIGINT) AS index_key,
DATE '2024-01-01' AS effective_from, DATE '9999-12-31' AS effective_to, CAST(1 AS TINYINT) AS is_current
FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey % 10 <> 3 AND c_nationkey < 5""")
def _(spark, d):
    bridge = dims.merge_memberships(None, M.memberships(spark, d, 3), date(2024, 1, 1)).withColumn("symbol", F.upper("symbol"))
    return lookups.resolve_bridge(bridge, M.customers_as_stocks(spark, d), stage(spark, d).dim_index)


@query("jon_7_membership_snapshot", """SELECT upper(s_name) AS symbol, CAST(r_regionkey AS BIGINT) AS index_id
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA' AND s_suppkey % 4 <> 0
UNION SELECT upper(s_name), CAST(r_regionkey AS BIGINT) FROM supplier, region WHERE r_name = 'ASIA' AND s_suppkey % 4 <> 0""")
def _(spark, d):
    everyone = M.instruments(spark, d)
    listing = everyone.where("sid % 4 <> 0")
    members = everyone.select(F.lower("exchange").alias("index_symbol"), "symbol")
    return lookups.membership_snapshot(listing, M.index_info(spark, d), members, composite="ASIA")


@query("jon_8_fact_to_sector", f"""WITH {S.EQUITY} SELECT t.stock_key, {S.DATE_KEY.format(c='e.trade_date')} AS date_key,
t.sector, CAST(t.sector_id AS INTEGER) AS sector_key FROM equity e JOIN stocks t ON t.symbol = e.symbol""")
def _(spark, d):
    s = stage(spark, d)
    return with_sector(s.fact_equity, s.dim_stock, s.dim_sector).select("stock_key", "date_key", "sector", "sector_key")


@query("jon_9_star_join", f"""WITH {S.SIGNALS} SELECT t.symbol, s.trade_date, s.close, s.label_trading_action
FROM signals s JOIN stocks t ON t.symbol = s.symbol""")
def _(spark, d):
    s = stage(spark, d)
    rows = lookups.star_join(
        s.fact_equity, [(s.dim_stock.select("stock_key", "symbol"), "stock_key"), (s.star.dates, "date_key")],
        s.fact_signals, ["stock_key", "date_key"])
    return rows.select("symbol", "trade_date", "close", "label_trading_action")


@query("jon_10_membership_changes", """SELECT c_name AS symbol, CAST(c_nationkey AS BIGINT) AS index_id,
CASE WHEN c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 THEN 'kept' WHEN c_custkey % 3 <> 0 THEN 'removed' ELSE 'added' END AS change
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 <> 0""")
def _(spark, d):
    history = dims.merge_memberships(None, M.memberships(spark, d, 3), date(2024, 1, 1))
    return dims.membership_changes(history, M.memberships(spark, d, 5))


# dimensions -----------------------------------------------------------------------------------

@query("dim_1_surrogate_keys", """SELECT upper(s_name) AS symbol, CAST(CASE WHEN s_suppkey % 3 = 0 THEN s_suppkey * 2 + 5
 ELSE (SELECT max(s_suppkey * 2 + 5) FROM supplier WHERE s_suppkey % 3 = 0)
      + row_number() OVER (PARTITION BY s_suppkey % 3 = 0 ORDER BY s_name) END AS INTEGER) AS stock_key FROM supplier""")
def _(spark, d):
    stocks = M.instruments(spark, d)
    mapping = stocks.where("sid % 3 = 0").select("symbol", (F.col("sid") * 2 + 5).cast("int").alias("stock_key"))
    return dims.assign_surrogate_keys(stocks.select("symbol"), mapping)[0]


@query("dim_1_updated_key_map", """SELECT c_name AS symbol, CAST(row_number() OVER (ORDER BY c_name) AS INTEGER) AS stock_key FROM customer""")
def _(spark, d):
    none = M.customers_as_stocks(spark, d).where(F.lit(False)).select("symbol", "stock_key")
    named = M.table(spark, d, "customer").select(F.col("c_name").alias("symbol"))
    return dims.assign_surrogate_keys(named, none)[1]


@query("dim_2_index_keys", INDEX_DIM.format(key="index_key"))
def _(spark, d):
    return dims.surrogate_from_source(dims.clean_index_info(M.index_info(spark, d)), "index_id", "index_key", "bigint")


@query("dim_2_sector_keys", "SELECT n_nationkey AS sector_key, n_name AS sector FROM nation")
def _(spark, d):
    return dims.surrogate_from_source(dims.clean_sector_info(M.sector_info(spark, d)), "sector_id", "sector_key")


@query("dim_3_scd2_merge", """SELECT c_name AS symbol, CAST(c_nationkey AS BIGINT) AS index_id,
 CASE WHEN c_custkey % 3 <> 0 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS effective_from,
 CASE WHEN c_custkey % 5 = 0 THEN DATE '2024-01-31' ELSE DATE '9999-12-31' END AS effective_to,
 CAST(CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE 1 END AS TINYINT) AS is_current
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 5 <> 0""")
def _(spark, d):
    history = dims.merge_memberships(None, M.memberships(spark, d, 3), date(2024, 1, 1))
    once = dims.merge_memberships(history, M.memberships(spark, d, 5), date(2024, 2, 1))
    return dims.merge_memberships(once, M.memberships(spark, d, 5), date(2024, 2, 1)).select(*schemas.SCD_COLUMNS)


@query("dim_4_calendar", f"WITH {S.PUBLISHED_CALENDAR} SELECT * FROM calendar")
def _(spark, d):
    return dims.publish_calendar(M.calendar(spark, d), M.market_events(spark, d))
