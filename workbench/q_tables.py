"""Sources, write modes, cleansing and set operations."""

from datetime import date
from uuid import uuid4

from pyspark.sql import functions as F

from candlewright import schemas
from candlewright.functions import cleanse as C
from candlewright.operators import dims
from candlewright.operators.lookups import join_summary
from candlewright.plans import flows
from candlewright.sources import lifecycle, scan, stream, writers
from candlewright.sources.replacing import ReplacingTable, star_table
from workbench import mapping as M
from workbench import sqlparts as S
from workbench.catalog import query, r, rounded, rx
from workbench.stage import scratch, stage

SPLIT, FROM = "2000-01-01", "1999-07-01"
BAR_VALUES = "symbol, trade_date, open, high, low, close, volume"
HALVES = S.BARS + f""",
old AS (SELECT * FROM bars WHERE trade_date < DATE '{SPLIT}'),
new AS (SELECT symbol, trade_date, open, high, low, close * 1.01 AS close, volume FROM bars WHERE trade_date >= DATE '{FROM}'),
merged AS (SELECT * FROM new UNION ALL SELECT * FROM old WHERE trade_date < DATE '{FROM}')"""


def halves(spark, d):
    bars = stage(spark, d).bars.select(*schemas.BAR_COLUMNS)
    old = bars.where(F.col("trade_date") < F.lit(SPLIT).cast("date"))
    new = bars.where(F.col("trade_date") >= F.lit(FROM).cast("date")).withColumn("close", F.col("close") * 1.01)
    return old, new


def fresh(spark):
    return scratch(spark, "written", uuid4().hex)


# sources --------------------------------------------------------------------------------------

@query("src_1_scan_one_kind", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem")
def _(spark, d):
    return scan.scan_kind(spark, d, "lineitem.parquet").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query("src_2_scan_one_day", f"""WITH {S.CANDLES} SELECT symbol, candle_time AS time, close FROM candles
WHERE CAST(candle_time AS DATE) = DATE '2024-01-05'""")
def _(spark, d):
    path = fresh(spark)
    writers.write_by_day(M.candles(spark, d).select("symbol", F.col("candle_time").alias("time"), "close"), path)
    return scan.only_day(spark.read.parquet(path), "2024-01-05").select("symbol", "time", "close")


@query("src_3_drifting_dates", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderkey % 3 < 3""")
def _(spark, d):
    orders = M.table(spark, d, "orders")
    part = lambda i: orders.where(F.col("o_orderkey") % 3 == i)
    return scan.scan_groups(spark, [
        part(0).select("o_orderkey", F.col("o_orderdate").alias("date")),
        part(1).select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("date")),
        part(2).select("o_orderkey", F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("date")),
    ])


@query("src_3_drifting_folder", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 3 AS DOUBLE) AS kind,
CASE WHEN o_orderkey % 3 = 1 THEN o_orderpriority END AS note FROM orders""")
def _(spark, d):
    """The folder holds files of three types of date and of two number types; it is read by its path alone."""
    path, orders = fresh(spark), M.table(spark, d, "orders")
    dates = [F.col("o_orderdate"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.unix_millis(F.col("o_orderdate").cast("timestamp"))]
    for i, day in enumerate(dates):
        rows = orders.where(F.col("o_orderkey") % 3 == i).select("o_orderkey", day.alias("date"), F.lit(i).cast("double" if i else "int").alias("kind"), F.col("o_orderpriority").alias("note"))
        (rows if i == 1 else rows.drop("note")).write.parquet(f"{path}/part{i}")
    return scan.scan_drifting(spark, path)


@query("src_4_projected_distinct", """SELECT DISTINCT o_orderstatus, CASE WHEN k = 0 THEN o_orderpriority END AS o_orderpriority
FROM orders, (VALUES (0), (1)) t(k)""")
def _(spark, d):
    orders = M.table(spark, d, "orders")
    return scan.project_distinct([orders, orders.drop("o_orderpriority")], ["o_orderstatus", "o_orderpriority"])


@query("src_5_optional_source", f"WITH {S.BARS} SELECT symbol, trade_date, close, CAST(NULL AS DOUBLE) AS pe FROM bars")
def _(spark, d):
    from pyspark.sql.types import DateType, DoubleType, StringType, StructField, StructType

    schema = StructType([StructField("symbol", StringType()), StructField("trade_date", DateType()), StructField("pe", DoubleType())])
    absent = scan.optional_table(spark, f"{d}/no_such_table.parquet", schema)
    return join_summary(stage(spark, d).bars, absent).select("symbol", "trade_date", "close", "pe")


# write modes ----------------------------------------------------------------------------------

@query("snk_1_skip_if_exists", f"WITH {HALVES} SELECT {BAR_VALUES} FROM old")
def _(spark, d):
    old, new = halves(spark, d)
    path = fresh(spark)
    writers.write_if_absent(old, path)
    writers.write_if_absent(new, path)
    return spark.read.parquet(path)


@query("snk_2_replace_snapshot", f"WITH {HALVES} SELECT {BAR_VALUES} FROM new")
def _(spark, d):
    old, new = halves(spark, d)
    path = fresh(spark)
    for df in (old, new, new.where(F.col("volume") < 0)):
        writers.replace_snapshot(df, path)
    return spark.read.parquet(path)


@query("snk_3_append_merge", f"WITH {HALVES} SELECT {BAR_VALUES} FROM merged")
def _(spark, d):
    path = fresh(spark)
    for df in halves(spark, d):
        writers.append_merge(df, path, ["symbol", "trade_date"])
    return spark.read.parquet(path)


@query("snk_3_append_merge_partitioned", f"WITH {HALVES} SELECT {BAR_VALUES}, CAST(year(trade_date) AS VARCHAR) AS year FROM merged")
def _(spark, d):
    path = fresh(spark)
    for df in halves(spark, d):
        writers.append_merge(df.withColumn("year", F.date_format("trade_date", "yyyy")), path, ["symbol", "trade_date"], ["year"])
    return spark.read.parquet(path).withColumn("year", F.col("year").cast("string"))


@query("snk_4_merge_common_columns", f"WITH {HALVES} SELECT symbol, trade_date, open, high, low, close FROM merged")
def _(spark, d):
    old, new = halves(spark, d)
    path = fresh(spark)
    writers.append_merge(old, path, ["symbol", "trade_date"])
    writers.append_merge(new.drop("volume").withColumn("extra", F.lit(1)), path, ["symbol", "trade_date"])
    return spark.read.parquet(path)


@query("snk_5_key_loss_guard", f"WITH {HALVES} SELECT {BAR_VALUES} FROM old")
def _(spark, d):
    """A merge that would lose keys is refused; the table stays as it was."""
    old, new = halves(spark, d)
    path = fresh(spark)
    writers.append_merge(old, path, ["symbol", "trade_date"], guard=True)
    try:
        writers.append_merge(new, path, ["symbol", "trade_date"], guard=True,
                             transform=lambda df: df.where(F.year("trade_date") != 1996))
        raise AssertionError("the guard let a key be lost")
    except writers.KeyLossError:
        return spark.read.parquet(path)


@query("snk_6_fallback_keys", f"WITH {HALVES} SELECT {BAR_VALUES} FROM merged")
def _(spark, d):
    old, new = halves(spark, d)
    keys = writers.dedup_keys(new.columns, primary=["id"], fallback=["symbol", "trade_date"])
    return writers.merge_rows(new, old, keys)


@query("snk_7_append_batches", f"""WITH {HALVES}
SELECT {BAR_VALUES}, 'bars_a' AS batch_label FROM old UNION ALL SELECT {BAR_VALUES}, 'bars_b' FROM new""")
def _(spark, d):
    old, new = halves(spark, d)
    path = fresh(spark)
    writers.append_batch(old.union(old), path, "bars_a", ["id"], ["symbol", "trade_date"])
    for _ in range(2):
        writers.append_batch(new, path, "bars_b", ["id"], ["symbol", "trade_date"])
    return spark.read.parquet(path)


@query("snk_8_day_partitions", f"""WITH {S.CANDLES} SELECT symbol, candle_time AS time, close,
strftime(candle_time, '%Y') AS year, strftime(candle_time, '%m') AS month, strftime(candle_time, '%d') AS day FROM candles""")
def _(spark, d):
    path = fresh(spark)
    rows = M.candles(spark, d).select("symbol", F.col("candle_time").alias("time"), "close")
    writers.write_by_day(rows.unionByName(rows.limit(1).withColumn("time", F.lit(None).cast("timestamp_ntz"))), path)
    back = spark.read.parquet(path)
    return back.withColumns({"year": F.col("year").cast("string"), "month": F.lpad(F.col("month").cast("string"), 2, "0"),
                             "day": F.lpad(F.col("day").cast("string"), 2, "0")})


@query("snk_9_summary_days", f"""SELECT upper(event_type) AS symbol, strftime(ts, '%Y-%m-%d') AS date,
{rx(6, 'avg(value) * CASE WHEN day(ts) >= 15 THEN 2 ELSE 1 END', 'eps')}, true AS stamped FROM events GROUP BY event_type, date, day(ts)""")
def _(spark, d):
    path = fresh(spark)
    first = M.table(spark, d, "events").groupBy(
        F.col("event_type").alias("symbol"), F.date_format("ts", "yyyy-MM-dd").alias("date")).agg(F.avg("value").alias("eps"))
    writers.merge_summary_days(first, path)
    writers.merge_summary_days(first.where("date >= '2024-01-15'").withColumn("eps", F.col("eps") * 2), path)
    out = spark.read.parquet(path).select("symbol", "date", "eps", F.col("ingested_at").isNotNull().alias("stamped"))
    return rounded(out, 6, "eps")


SCD_BRIDGE = """SELECT CAST(c_custkey + 1 AS INTEGER) AS stock_key, CAST(c_nationkey AS BIGINT) AS index_key,
 DATE '2024-01-01' AS effective_from, DATE '2149-06-06' AS effective_to, CAST(1 AS TINYINT) AS is_current
 FROM customer WHERE c_custkey % 3 <> 0"""


@query("snk_10_load_aligned", SCD_BRIDGE)
def _(spark, d):
    source = dims.merge_memberships(None, M.memberships(spark, d, 3), date(2024, 1, 1))
    keyed = source.select((F.substring("symbol", 10, 20).cast("int") + 1).alias("stock_key"), F.col("index_id").alias("index_key"),
                          "effective_from", "effective_to", "is_current", F.lit("x").alias("not_in_target"))
    path = fresh(spark)
    writers.load_table(keyed, path, schemas.BRIDGE_STOCK_INDEX)
    return spark.read.parquet(path)


@query("snk_10_load_verified", "SELECT count(*) AS source_rows, count(*) AS loaded_rows, true AS verified FROM customer WHERE c_custkey % 3 <> 0")
def _(spark, d):
    source = dims.merge_memberships(None, M.memberships(spark, d, 3), date(2024, 1, 1)).withColumnRenamed("index_id", "index_key")
    return writers.load_table(source, fresh(spark), schemas.BRIDGE_STOCK_INDEX)


@query("snk_11_archive_days", """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n,
 CASE WHEN day(ts) <= 10 THEN 'skipped' ELSE 'archived' END AS status FROM events GROUP BY 1, day(ts)""")
def _(spark, d):
    path = fresh(spark)
    candles = M.candles(spark, d)
    lifecycle.archive(candles.where(F.dayofmonth("candle_time") <= 10), "candle_time", path)
    return lifecycle.archive(candles, "candle_time", path)


@query("snk_11_archived_rows", f"WITH {S.CANDLES} SELECT symbol, candle_time, close, CAST(candle_time AS DATE) AS date FROM candles")
def _(spark, d):
    path = fresh(spark)
    lifecycle.archive(M.candles(spark, d).select("symbol", "candle_time", "close"), "candle_time", path)
    return spark.read.parquet(path).withColumn("date", F.col("date").cast("date"))


@query("snk_11_archive_one_day", """SELECT k AS run, '2024-01-09' AS date, (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09') AS n,
CASE WHEN k = 1 THEN 'archived' ELSE 'skipped' END AS status FROM (VALUES (1), (2)) t(k)
UNION ALL SELECT 3, '2023-12-31', (SELECT count(*) FROM events WHERE CAST(ts AS DATE) = DATE '2023-12-31'), 'empty'""")
def _(spark, d):
    """One day of a table by days: archived, then skipped; a day without rows is empty."""
    table, kept, candles = fresh(spark), fresh(spark), M.candles(spark, d)
    lifecycle.archive(candles.select("event_id", "candle_time"), "candle_time", table)
    runs = [lifecycle.archive(spark.read.parquet(table), "candle_time", kept, day=day).withColumn("run", F.lit(i))
            for i, day in ((1, "2024-01-09"), (3, "2023-12-31"))]
    done = [spark.createDataFrame(r.collect(), r.schema) for r in runs]
    again = lifecycle.archive(spark.read.parquet(table), "candle_time", kept, day="2024-01-09").withColumn("run", F.lit(2))
    return done[0].unionByName(again).unionByName(done[1])


def _archived(spark, d):
    return M.candles(spark, d).where(F.dayofmonth("candle_time") % 2 == 0).select(
        F.date_format("candle_time", "yyyy-MM-dd").alias("date")).distinct()


@query("snk_12_purge_plan", """SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS n,
 CASE WHEN day(ts) % 2 = 0 THEN 'purged' ELSE 'kept' END AS status FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1, day(ts)""")
def _(spark, d):
    return lifecycle.purge_plan(M.candles(spark, d), "candle_time", _archived(spark, d), date(2024, 1, 15))


@query("snk_12_purged_rows", "SELECT event_id, ts AS candle_time FROM events WHERE NOT (ts < TIMESTAMP '2024-01-15' AND day(ts) % 2 = 0)")
def _(spark, d):
    return lifecycle.purged(M.candles(spark, d), "candle_time", _archived(spark, d), date(2024, 1, 15)).select("event_id", "candle_time")


@query("snk_12_purged_partitions", "SELECT event_id, CAST(ts AS DATE) AS date FROM events WHERE NOT (ts < TIMESTAMP '2024-01-15' AND day(ts) % 2 = 0)")
def _(spark, d):
    table, kept = fresh(spark), fresh(spark)
    candles = M.candles(spark, d)
    lifecycle.archive(candles, "candle_time", table)
    lifecycle.archive(candles.where(F.dayofmonth("candle_time") % 2 == 0), "candle_time", kept)
    lifecycle.purge_partitions(spark, table, kept, date(2024, 2, 14), 30)
    return spark.read.parquet(table).select("event_id", F.col("date").cast("date").alias("date"))


@query("snk_13_time_to_live", "SELECT event_id, ts AS candle_time FROM events WHERE CAST(ts AS DATE) + 45 > DATE '2024-03-01'")
def _(spark, d):
    return lifecycle.unexpired(M.candles(spark, d), "candle_time", date(2024, 3, 1)).select("event_id", "candle_time")


@query("snk_13_expired_rows", "SELECT event_id, ts AS candle_time FROM events WHERE CAST(ts AS DATE) + 45 > DATE '2024-03-01'")
def _(spark, d):
    """Expired days are gone from the table itself; a second run finds nothing to do."""
    table = fresh(spark)
    lifecycle.archive(M.candles(spark, d).select("event_id", "candle_time"), "candle_time", table)
    lifecycle.expire(spark, table, "candle_time", date(2024, 3, 1))
    if lifecycle.expire(spark, table, "candle_time", date(2024, 3, 1)):
        raise ValueError("the second run found expired rows")
    return spark.read.parquet(table).select("event_id", "candle_time")


@query("snk_14_latest_per_key", f"""WITH {S.REVISED}
SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, candle_time ORDER BY received_at DESC) AS k FROM revised) WHERE k = 1""")
def _(spark, d):
    return writers.latest_per_key(M.revised_candles(spark, d), ["symbol", "candle_time"], "received_at")


@query("snk_14_replacing_table", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderkey <= (SELECT quantile_disc(o_orderkey, 0.01) FROM orders) THEN o_totalprice + 1
WHEN o_orderkey % 50 = 7 THEN o_totalprice - 1 ELSE o_totalprice END AS o_totalprice FROM orders""")
def _(spark, d):
    """Loaded whole, one in fifty keys again, brought together, and one per cent of the keys, in a row, once more."""
    orders = M.table(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_totalprice")
    table = ReplacingTable(spark, fresh(spark), orders.schema, ["o_orderkey"])
    moved = lambda rows, by: rows.withColumn("o_totalprice", F.col("o_totalprice") + by)
    table.replace(orders)
    table.upsert(moved(orders.where("o_orderkey % 50 = 7"), -1))
    table.compact()
    first = orders.agg(F.expr("percentile_disc(0.01) WITHIN GROUP (ORDER BY o_orderkey)")).first()[0]
    table.upsert(moved(orders.where(F.col("o_orderkey") <= first), 1))
    return table.read()


@query("snk_10_star_bindings", f"""WITH {S.SECTOR} SELECT CAST(sector_key AS INTEGER) AS sector_key, CAST(date_key AS INTEGER) AS date_key, stock_count FROM sector""")
def _(spark, d):
    """The sector facts through their own binding: half of the days, then all of them, the later load winning."""
    facts = stage(spark, d).fact_sector
    table = star_table(spark, fresh(spark), "fact_market_sector")
    table.replace(facts.where("date_key % 2 = 0").withColumn("stock_count", F.lit(-1)))
    table.upsert(facts)
    table.compact()
    return table.read().select(F.col("sector_key").cast("int").alias("sector_key"), F.col("date_key").cast("int").alias("date_key"), F.col("stock_count").cast("int").alias("stock_count"))


# cleansing ------------------------------------------------------------------------------------

@query("prj_1_symbols", "SELECT DISTINCT upper(c_mktsegment) AS symbol FROM customer")
def _(spark, d):
    messy = M.table(spark, d, "customer").select(F.explode(F.array(
        F.concat(F.lit("  "), F.lower("c_mktsegment"), F.lit(" ")), F.lit(" "), F.lit(None))).alias("symbol"))
    return C.normalise_symbols(messy)


@query("prj_2_dates_any_encoding", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS a, CAST(o_orderdate AS DATE) AS b,
CAST(o_orderdate AS DATE) AS c, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS e FROM orders""")
def _(spark, d):
    t = F.col("o_orderdate")
    raw = M.table(spark, d, "orders").select(
        "o_orderkey", t.cast("date").alias("a"), F.unix_millis(t.cast("timestamp")).alias("b"), t.alias("c"),
        F.when(F.col("o_orderkey") % 5 == 0, "bad").otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")).alias("e"))
    for column in "abce":
        raw = C.with_date(raw, column)
    return raw


@query("prj_3_datetimes", "SELECT event_id, date_trunc('second', ts) AS time FROM events WHERE event_id % 5 <> 0")
def _(spark, d):
    raw = M.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, "bad").otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).alias("time"))
    out = raw.withColumn("time", C.to_datetime_any("time", raw.schema["time"].dataType))
    return out.where(F.col("time").isNotNull()).withColumn("time", F.col("time").cast("timestamp_ntz"))


@query("prj_4_metrics", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE value END AS pe, CAST(NULL AS DOUBLE) AS pb FROM events")
def _(spark, d):
    raw = M.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("pe"))
    return raw.select("event_id", *C.metric_columns(raw, ["pe", "pb"]))


@query("prj_5_whole_numbers", "SELECT event_id, CAST(value AS BIGINT) AS v FROM events WHERE value % 1 = 0 AND event_id % 4 <> 0")
def _(spark, d):
    return C.coerce_whole_number(_texts(spark, d), "v")


@query("prj_5_whole_numbers_nulled", "SELECT event_id, CASE WHEN value % 1 = 0 AND event_id % 4 <> 0 THEN CAST(value AS BIGINT) END AS v FROM events")
def _(spark, d):
    return C.coerce_whole_number(_texts(spark, d), "v", drop_invalid=False)


def _texts(spark, d):
    return M.table(spark, d, "events").select("event_id", F.when(F.col("event_id") % 4 == 0, "x").otherwise(F.col("value").cast("string")).alias("v"))


@query("prj_6_utf8_bytes", "SELECT doc_id, md5(text) AS digest, length(text) AS n FROM documents")
def _(spark, d):
    raw = M.table(spark, d, "documents").select("doc_id", F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF"))).alias("b"))
    text = C.decode_utf8("b")
    return raw.select("doc_id", F.md5(text).alias("digest"), F.length(text).cast("bigint").alias("n"))


@query("prj_7_fill_blank_symbol", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN upper(o_orderpriority) ELSE 'VNM' END AS symbol FROM orders")
def _(spark, d):
    k = F.col("o_orderkey") % 3
    raw = M.table(spark, d, "orders").select("o_orderkey", F.when(k == 0, " ").when(k == 2, F.col("o_orderpriority")).alias("symbol"))
    return C.fill_blank_symbol(raw, " vnm ")


@query("prj_8_listing", f"WITH {S.EQUITY} SELECT symbol, exchange, type FROM stocks WHERE exchange = 'ASIA' AND type = 'STOCK'")
def _(spark, d):
    listing = M.instruments(spark, d).withColumn("exchange", F.lower("exchange"))
    return C.filter_listing(listing, "Asia", "stock").select("symbol", F.upper("exchange").alias("exchange"), "type")


@query("prj_9_min_date", "SELECT o_orderkey FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderdate >= TIMESTAMP '1999-06-01'")
def _(spark, d):
    raw = M.table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "bad").otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return C.filter_min_date(raw, "day", "1999-06-01").select("o_orderkey")


@query("prj_10_ingest_time", "SELECT s_suppkey, true AS stamped FROM supplier")
def _(spark, d):
    stamped = C.with_ingested_at(M.table(spark, d, "supplier"))
    return stamped.select("s_suppkey", (F.col("ingested_at") <= F.current_timestamp()).alias("stamped"))


@query("prj_11_drop_audit_columns", "SELECT * FROM supplier")
def _(spark, d):
    return C.drop_audit_columns(C.with_ingested_at(C.with_ingested_at(M.table(spark, d, "supplier")), "ingested_at_right"))


ITEMS = """SELECT DISTINCT upper(c_name) AS symbol, CAST(o_orderdate AS DATE) AS public_date, {columns} FROM orders JOIN customer ON o_custkey = c_custkey"""
EVENT_ITEMS = ITEMS.format(columns="o_orderpriority AS event_name_vi, 'Order ' || o_orderkey AS event_title_vi, o_orderstatus AS event_code")
NEWS_ITEMS = ITEMS.format(columns="'News ' || o_orderkey AS news_title, o_orderpriority AS news_short_content, CAST(NULL AS VARCHAR) AS news_image_url, 'src/' || o_orderkey AS news_source_link")


@query("prj_12_conform", f"SELECT symbol, public_date AS published, event_code FROM ({EVENT_ITEMS})")
def _(spark, d):
    clean = dims.clean_company_items(M.raw_company_events(spark, d), schemas.EVENT_COLUMNS, "ticker")
    return C.conform(clean, ["symbol", "published", "event_code"], {"public_date": "published"}, ["symbol", "published"])


@query("prj_13_date_key", f"SELECT o_orderkey, {S.DATE_KEY.format(c='o_orderdate')} AS date_key FROM orders")
def _(spark, d):
    return M.table(spark, d, "orders").select("o_orderkey", C.date_key("o_orderdate").alias("date_key"))


FANOUT = S.CALENDAR + """,
joined AS (SELECT d.date, e.event_name, e.event_type FROM days d LEFT JOIN day_events e ON e.date = d.date)"""


@query("prj_14_calendar_flags", f"""WITH {FANOUT} SELECT date, CAST(year(date) AS BIGINT) AS cal_year,
CASE WHEN isodow(date) >= 6 THEN 'Cuối tuần' ELSE event_name END AS event_name,
CAST(CASE WHEN isodow(date) >= 6 OR coalesce(trim(event_type), '') <> '' THEN 1 ELSE 0 END AS TINYINT) AS is_day_off FROM joined""")
def _(spark, d):
    joined = dims.join_calendar_events(M.calendar(spark, d), M.market_events(spark, d))
    return dims.calendar_flags(joined).select("date", "cal_year", "event_name", "is_day_off")


@query("prj_15_index_members", "SELECT DISTINCT 'VN30' AS index_symbol, upper(c_mktsegment) AS symbol FROM customer")
def _(spark, d):
    members = M.table(spark, d, "customer").select(F.concat(F.lit(" "), F.lower("c_mktsegment")).alias("symbol"))
    return C.index_members(members, "VN30")


INDEX_DIM = """SELECT CAST(r_regionkey AS BIGINT) AS {key}, r_name AS index_symbol, r_name AS index_name,
 'index of a region' AS description, 'REGION' AS "group" FROM region"""


@query("prj_16_index_dim", INDEX_DIM.format(key="index_id"))
def _(spark, d):
    info = M.index_info(spark, d)
    return dims.clean_index_info(info.unionByName(info).unionByName(info.withColumn("index_id", F.lit("x"))))


@query("prj_17_sector_dim", "SELECT n_nationkey AS sector_id, n_name AS sector FROM nation")
def _(spark, d):
    return dims.clean_sector_info(M.sector_info(spark, d).unionByName(M.sector_info(spark, d)))


@query("prj_18_company_events", EVENT_ITEMS)
def _(spark, d):
    raw = M.raw_company_events(spark, d)
    return dims.clean_company_items(raw.unionByName(raw), schemas.EVENT_COLUMNS, "ticker")


@query("prj_18_company_news", NEWS_ITEMS)
def _(spark, d):
    return dims.clean_company_items(M.raw_company_news(spark, d), schemas.NEWS_COLUMNS)


SUMMARY_VALUES = r(4, "high_52w", "low_52w", "beta", "eps", "bvps", "market_cap", "pe", "pb", "roe", "dividend_yield")


@query("prj_19_summary", f"WITH {S.PRINTS} {S.SUMMARY} SELECT symbol, trade_date, {SUMMARY_VALUES} FROM summary")
def _(spark, d):
    raw = M.raw_summary(spark, d)
    return rounded(flows.clean_summary(raw.unionByName(raw)), 4, *schemas.SUMMARY_METRICS)


@query("prj_20_message_shape", f"""WITH {S.CANDLES} SELECT symbol, 'STOCK' AS market_type,
date_trunc('second', candle_time) AS candle_time, date_trunc('millisecond', received_at) AS received_at FROM candles""")
def _(spark, d):
    from workbench.q_streams import candle_messages, ntz

    parsed = stream.parse_messages(candle_messages(spark, d).select("value"), schemas.CANDLE_MESSAGE, ["symbol"])
    return ntz(stream.shape_candles(parsed), "candle_time", "received_at").select("symbol", "market_type", "candle_time", "received_at")


# sets -----------------------------------------------------------------------------------------

@query("set_1_union_by_name", """SELECT s_suppkey, s_name, CAST(NULL AS DOUBLE) AS s_acctbal FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey, NULL, s_acctbal FROM supplier WHERE s_suppkey % 2 = 1""")
def _(spark, d):
    s = M.table(spark, d, "supplier")
    return scan.union_all([s.where("s_suppkey % 2 = 0").select("s_suppkey", "s_name"), s.where("s_suppkey % 2 = 1").select("s_suppkey", "s_acctbal")])


@query("set_2_union_distinct", "SELECT DISTINCT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def _(spark, d):
    return scan.union_distinct([M.table(spark, d, "customer").select(F.col("c_nationkey").alias("k")),
                                M.table(spark, d, "supplier").select(F.col("s_nationkey").alias("k"))])


@query("set_3_keep_first", """SELECT * EXCLUDE (k) FROM (SELECT o_custkey, o_orderkey, o_totalprice,
row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders) WHERE k = 1""")
def _(spark, d):
    orders = M.table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return C.keep_first(orders, ["o_custkey"], ["o_orderkey"])


@query("set_4_new_keys", "SELECT c_name AS symbol FROM customer WHERE c_custkey % 3 = 0")
def _(spark, d):
    now = M.table(spark, d, "customer").select(F.col("c_name").alias("symbol"))
    return dims.new_keys(now, M.memberships(spark, d, 3), "symbol")
