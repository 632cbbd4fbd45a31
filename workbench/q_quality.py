"""Data-quality checks: each on a given table, with its verdict and counts in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from candlewright.operators import lookups
from candlewright.quality.checks import inconsistent_rows, repeated_rows
from candlewright.quality.gates import GATES
from candlewright.quality.suite import QualityError, gate, report
from workbench import mapping as M
from workbench import sqlparts as S
from workbench.catalog import query, rounded, rx
from workbench.stage import stage

VALUES = "unexpected_count, unexpected_percent, observed_value"


def line(table, check, column, success, n="count(*)", bad=None, considered=None, observed=None):
    """One report row in SQL."""
    unexpected = "CAST(NULL AS BIGINT)" if bad is None else f"CAST({bad} AS BIGINT)"
    percent = "CAST(NULL AS DOUBLE)" if bad is None else f"coalesce(({bad}) * 100.0::DOUBLE / nullif({considered or n}, 0), 0)"
    seen = "CAST(NULL AS DOUBLE)" if observed is None else f"CAST({observed} AS DOUBLE)"
    return (f"""SELECT '{check}' AS "check", '{column}' AS "column", coalesce({success}, false) AS success, CAST({n} AS BIGINT) AS element_count,
 {unexpected} AS unexpected_count, {rx(6, percent, 'unexpected_percent')}, {rx(6, seen, 'observed_value')} FROM {table}""")


def rows(table, check, column, bad, ignored="false", mostly=1.0):
    wrong = f"count(*) FILTER (WHERE NOT ({ignored}) AND coalesce({bad}, true))"
    considered = f"count(*) FILTER (WHERE NOT ({ignored}))"
    return line(table, check, column, f"{considered} - {wrong} >= {considered} * {mostly}", bad=wrong, considered=considered)


def values(table, check, column, bad):
    return rows(table, check, column, bad, f"{column} IS NULL")


def stat(table, check, column, expression, condition):
    return line(table, check, column, f"({expression}) {condition}", observed=expression)


def add(number, check, table, config, sql):
    def run(spark, d):
        return rounded(report(M.table(spark, d, table), [(check, config)]), 6, "unexpected_percent", "observed_value")

    query(f"dq_{number}_{check}", sql)(run)


T = "timestamp_ntz"
add("01", "column_not_null", "orders", {"column": "o_custkey"}, rows("orders", "column_not_null", "o_custkey", "o_custkey IS NULL"))
add("02", "columns_not_null", "lineitem", {"columns": ["l_orderkey", "l_shipdate"], "mostly": 0.9}, " UNION ALL ".join(
    rows("lineitem", "columns_not_null", c, f"{c} IS NULL", mostly=0.9) for c in ("l_orderkey", "l_shipdate")))
add("03", "column_be_null", "orders", {"column": "o_orderstatus"}, rows("orders", "column_be_null", "o_orderstatus", "o_orderstatus IS NOT NULL"))
add("04", "columns_be_null", "customer", {"columns": ["c_name", "c_acctbal"]}, " UNION ALL ".join(
    rows("customer", "columns_be_null", c, f"{c} IS NOT NULL") for c in ("c_name", "c_acctbal")))
add("05", "column_non_null_proportion_between", "orders", {"column": "o_totalprice", "min_value": 0.5, "max_value": 1.0},
    stat("orders", "column_non_null_proportion_between", "o_totalprice", "count(o_totalprice) * 1.0 / count(*)", "BETWEEN 0.5 AND 1"))
add("06", "row_has_at_least_one_non_null", "part", {"columns": ["p_name", "p_brand"]},
    rows("part", "row_has_at_least_one_non_null", "p_name,p_brand", "p_name IS NULL AND p_brand IS NULL"))
add("07", "column_a_greater_than_b", "lineitem", {"column_a": "l_discount", "column_b": "l_tax"},
    rows("lineitem", "column_a_greater_than_b", "l_discount,l_tax", "NOT (l_discount >= l_tax)", "l_discount IS NULL AND l_tax IS NULL"))
add("08", "multicolumn_sum_to_equal", "lineitem", {"column_list": ["l_linenumber", "l_quantity"], "sum_total": 20},
    rows("lineitem", "multicolumn_sum_to_equal", "l_linenumber,l_quantity", "l_linenumber + l_quantity <> 20"))
add("09", "group_consistency", "lineitem", {"group_col": "l_orderkey", "value_col": "l_linestatus"}, line(
    "(SELECT l_orderkey, count(*) AS n, count(DISTINCT l_linestatus) AS k FROM lineitem GROUP BY 1)", "group_consistency",
    "l_orderkey,l_linestatus", "count(*) FILTER (WHERE k > 1) = 0", n="sum(n)", bad="coalesce(sum(n) FILTER (WHERE k > 1), 0)",
    observed="count(*) FILTER (WHERE k > 1)"))
add("10", "column_datetime_range", "orders", {"column": "o_orderdate", "start_time": "1996-01-01", "end_time": "2000-01-01", "strict_end": True},
    values("orders", "column_datetime_range", "o_orderdate", "NOT (o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '2000-01-01')"))
add("11", "column_values_between", "lineitem", {"column": "l_quantity", "min_value": 1, "max_value": 40, "strict_min": True},
    values("lineitem", "column_values_between", "l_quantity", "NOT (l_quantity > 1 AND l_quantity <= 40)"))
add("12", "column_max_between", "lineitem", {"column": "l_quantity", "min_value": 10, "max_value": 50, "strict_max": True},
    stat("lineitem", "column_max_between", "l_quantity", "max(l_quantity)", "BETWEEN 10 AND 49.999"))
add("13", "column_min_between", "lineitem", {"column": "l_quantity", "min_value": 1}, stat("lineitem", "column_min_between", "l_quantity", "min(l_quantity)", ">= 1"))
add("14", "column_mean_between", "orders", {"column": "o_totalprice", "min_value": 1000, "max_value": 100000},
    stat("orders", "column_mean_between", "o_totalprice", "avg(o_totalprice)", "BETWEEN 1000 AND 100000"))
add("15", "column_median_between", "orders", {"column": "o_totalprice", "min_value": 1000, "max_value": 500000},
    stat("orders", "column_median_between", "o_totalprice", "median(o_totalprice)", "BETWEEN 1000 AND 500000"))
STATUS = {"values": ["F", "O", "P"], "weights": [0.4, 0.4, 0.2]}
add("16", "column_kl_divergence_less_than", "orders", {"column": "o_orderstatus", "partition_object": STATUS, "threshold": 0.2}, line(
    """(SELECT o_orderstatus, count(*) AS n, count(*) * 1.0 / (SELECT count(*) FROM orders) AS p,
       CASE o_orderstatus WHEN 'P' THEN 0.2 ELSE 0.4 END AS q FROM orders GROUP BY 1)""",
    "column_kl_divergence_less_than", "o_orderstatus", "sum(p * ln(p / q)) < 0.2", n="sum(n)", observed="sum(p * ln(p / q))"))
add("17", "column_quantile_values_to_be_between", "lineitem", {"column": "l_extendedprice", "quantile_ranges": {
    "quantiles": [0.1, 0.5, 0.9], "value_ranges": [[0, 50000], [1000, None], [None, 60000]]}}, line(
    """(SELECT max(CASE WHEN k = round_even((n - 1) * 0.1, 0) THEN l_extendedprice END) AS a, max(CASE WHEN k = round_even((n - 1) * 0.5, 0) THEN l_extendedprice END) AS b,
        max(CASE WHEN k = round_even((n - 1) * 0.9, 0) THEN l_extendedprice END) AS c, max(n) AS n FROM (SELECT l_extendedprice, row_number() OVER (ORDER BY l_extendedprice) - 1 AS k,
        count(*) OVER () AS n FROM lineitem))""",
    "column_quantile_values_to_be_between", "l_extendedprice", "a BETWEEN 0 AND 50000 AND b >= 1000 AND c <= 60000", n="n", observed="a"))
add("18", "column_stdev_to_be_between", "lineitem", {"column": "l_quantity", "min_value": 1, "max_value": 15},
    stat("lineitem", "column_stdev_to_be_between", "l_quantity", "stddev_samp(l_quantity)", "BETWEEN 1 AND 15"))
add("19", "column_sum_to_be_between", "lineitem", {"column": "l_quantity", "max_value": 1000, "strict_max": True},
    stat("lineitem", "column_sum_to_be_between", "l_quantity", "sum(l_quantity)", "< 1000"))
add("20", "column_value_zscores_to_be_less_than", "orders", {"column": "o_totalprice", "threshold": 1.6},
    values("(SELECT o_totalprice, (o_totalprice - avg(o_totalprice) OVER ()) / stddev_samp(o_totalprice) OVER () AS z FROM orders)",
           "column_value_zscores_to_be_less_than", "o_totalprice", "NOT (abs(z) < 1.6)"))
REGION, SUPPLIER = ["r_name", "r_regionkey"], ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
add("21", "columns_to_match_set", "region", {"column_set": REGION}, line("region", "columns_to_match_set", "r_name,r_regionkey", "true", observed="2"))
add("22", "columns_to_match_ordered_list", "supplier", {"column_list": SUPPLIER[::-1]},
    line("supplier", "columns_to_match_ordered_list", ",".join(SUPPLIER[::-1]), "false", observed="4"))
add("23", "table_column_count_equal", "supplier", {"value": 4}, line("supplier", "table_column_count_equal", "*", "true", observed="4"))
add("24", "column_values_to_be_in_type_list", "orders", {"column": "o_totalprice", "type_list": ["float", "double"]},
    line("orders", "column_values_to_be_in_type_list", "o_totalprice", "true"))
add("25", "column_values_to_be_of_type", "orders", {"column": "o_totalprice", "expected_type": "bigint"},
    line("orders", "column_values_to_be_of_type", "o_totalprice", "false"))
add("26", "column_to_exist", "orders", {"column": "o_comment"}, line("orders", "column_to_exist", "o_comment", "false"))
add("27", "table_column_count_between", "orders", {"min_value": 3, "max_value": 10}, line("orders", "table_column_count_between", "*", "true", observed="6"))
add("28", "column_values_in_set", "documents", {"column": "lang", "value_set": ["en", "de", "fr"]},
    values("documents", "column_values_in_set", "lang", "lang NOT IN ('en', 'de', 'fr')"))
add("29", "column_most_common_value_in_set", "orders", {"column": "o_orderpriority", "value_set": ["1-URGENT", "5-LOW"], "ties_okay": True}, line(
    "(SELECT o_orderpriority AS v, count(*) AS n, max(count(*)) OVER () AS top, sum(count(*)) OVER () AS total FROM orders GROUP BY 1)",
    "column_most_common_value_in_set", "o_orderpriority", "count(*) FILTER (WHERE n = top AND v IN ('1-URGENT', '5-LOW')) > 0",
    n="max(total)", observed="count(*) FILTER (WHERE n = top)"))
add("30", "column_value_lengths_to_equal", "supplier", {"column": "s_name", "value": 18}, values("supplier", "column_value_lengths_to_equal", "s_name", "length(s_name) <> 18"))
add("31", "column_value_lengths_between", "documents", {"column": "text", "min_value": 10, "max_value": 5000},
    values("documents", "column_value_lengths_between", "text", "NOT length(text) BETWEEN 10 AND 5000"))
add("32", "column_pair_values_in_set", "lineitem", {"column_a": "l_returnflag", "column_b": "l_linestatus", "value_pairs_set": [("A", "F"), ("N", "O"), ("R", "F")]},
    rows("lineitem", "column_pair_values_in_set", "l_returnflag,l_linestatus", "(l_returnflag, l_linestatus) NOT IN (('A', 'F'), ('N', 'O'), ('R', 'F'))",
         "l_returnflag IS NULL AND l_linestatus IS NULL"))
add("33", "column_pair_values_equal", "lineitem", {"column_a": "l_discount", "column_b": "l_tax"},
    rows("lineitem", "column_pair_values_equal", "l_discount,l_tax", "l_discount IS DISTINCT FROM l_tax", "l_discount IS NULL AND l_tax IS NULL"))
add("34", "column_values_match_regex", "pages", {"column": "url", "regex": "^https://"}, values("pages", "column_values_match_regex", "url", "NOT regexp_matches(url, '^https://')"))
add("35", "column_values_match_regex_list", "documents", {"column": "text", "regex_list": ["the", "[0-9]{3}"], "match_on": "all"},
    values("documents", "column_values_match_regex_list", "text", "NOT (regexp_matches(text, 'the') AND regexp_matches(text, '[0-9]{3}'))"))
add("36", "column_values_match_like_list", "pages", {"column": "url", "like_pattern_list": ["%com%", "%org%"]},
    values("pages", "column_values_match_like_list", "url", "NOT (url LIKE '%com%' OR url LIKE '%org%')"))
add("37", "column_values_not_in_set", "conversations", {"column": "role", "value_set": ["system", "tool"]},
    values("conversations", "column_values_not_in_set", "role", "role IN ('system', 'tool')"))
add("38", "column_values_not_match_regex", "documents", {"column": "text", "regex": "[0-9]{4}"}, values("documents", "column_values_not_match_regex", "text", "regexp_matches(text, '[0-9]{4}')"))
add("39", "column_values_not_match_regex_list", "documents", {"column": "text", "regex_list": ["@", "http"]},
    values("documents", "column_values_not_match_regex_list", "text", "regexp_matches(text, '@') OR regexp_matches(text, 'http')"))
add("40", "column_values_unique", "lineitem", {"column": "l_partkey"}, line(
    "(SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1)", "column_values_unique", "l_partkey", "sum(CASE WHEN n > 1 THEN n ELSE 0 END) = 0", n="sum(n)",
    bad="sum(CASE WHEN n > 1 THEN n ELSE 0 END)"))
add("41", "compound_columns_unique", "lineitem", {"column_list": ["l_orderkey", "l_linenumber"]}, line(
    "(SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)", "compound_columns_unique", "l_orderkey,l_linenumber",
    "sum(CASE WHEN n > 1 THEN n ELSE 0 END) = 0", n="sum(n)", bad="sum(CASE WHEN n > 1 THEN n ELSE 0 END)"))
SEGMENTS = ["BUILDING", "MACHINERY", "HOUSEHOLD"]
DISTINCT = "(SELECT c_mktsegment AS v, count(*) AS n FROM customer GROUP BY 1)"
IN = "v IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"
for _n, _check, _ok in (
    ("42", "column_distinct_values_in_set", f"count(*) FILTER (WHERE NOT {IN}) = 0"),
    ("43", "column_distinct_values_to_equal_set", f"count(*) FILTER (WHERE NOT {IN}) = 0 AND count(*) FILTER (WHERE {IN}) = 3"),
    ("44", "column_distinct_values_contain_set", f"count(*) FILTER (WHERE {IN}) = 3"),
):
    add(_n, _check, "customer", {"column": "c_mktsegment", "value_set": SEGMENTS}, line(DISTINCT, _check, "c_mktsegment", _ok, n="sum(n)", observed="count(v)"))
add("45", "select_column_values_unique_within_record", "lineitem", {"column_list": ["l_linenumber", "l_suppkey"]},
    rows("lineitem", "select_column_values_unique_within_record", "l_linenumber,l_suppkey", "l_linenumber = l_suppkey"))
add("46", "column_unique_value_count_to_be_between", "orders", {"column": "o_custkey", "min_value": 10, "max_value": 100000},
    stat("orders", "column_unique_value_count_to_be_between", "o_custkey", "count(DISTINCT o_custkey)", "BETWEEN 10 AND 100000"))
add("47", "column_proportion_of_unique_values_to_be_between", "orders", {"column": "o_custkey", "min_value": 0.5},
    stat("orders", "column_proportion_of_unique_values_to_be_between", "o_custkey", "count(DISTINCT o_custkey) * 1.0 / count(o_custkey)", ">= 0.5"))
add("48", "table_row_count_between", "orders", {"min_value": 1, "max_value": 10, "strict_max": True}, stat("orders", "table_row_count_between", "*", "count(*)", "BETWEEN 1 AND 9"))
add("49", "table_row_count_to_equal", "region", {"value": 5}, stat("region", "table_row_count_to_equal", "*", "count(*)", "= 5"))


@query("dq_09_inconsistent_rows", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey IN
(SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_linestatus) > 1)""")
def _(spark, d):
    return inconsistent_rows(M.table(spark, d, "lineitem"), "l_orderkey", "l_linestatus").select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_41_repeated_rows", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE (l_orderkey, l_linenumber) IN
(SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""")
def _(spark, d):
    return repeated_rows(M.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey")


@query("dq_50_gate_suite", f"""WITH {S.EQUITY} SELECT "check", "column", success, element_count, unexpected_count FROM (
{rows('equity', 'column_a_greater_than_b', 'high,low', 'NOT (high >= low)')} UNION ALL
{values('equity', 'column_values_between', 'close', 'NOT (close > 0 AND close <= 10000000)')} UNION ALL
{values('equity', 'column_values_between', 'total_volume', 'NOT (total_volume >= 0 AND total_volume <= 1e12)')} UNION ALL
{values('equity', 'column_values_between', 'rsi_14', 'NOT (rsi_14 >= 0 AND rsi_14 <= 100)')} UNION ALL
{line('(SELECT symbol, trade_date, count(*) AS n FROM equity GROUP BY 1, 2)', 'compound_columns_unique', 'symbol,trade_date', 'max(n) = 1', n='sum(n)', bad='count(*) FILTER (WHERE n > 1)')} UNION ALL
{rows('equity', 'columns_not_null', 'symbol', 'symbol IS NULL')} UNION ALL {rows('equity', 'columns_not_null', 'trade_date', 'trade_date IS NULL')} UNION ALL
{rows('equity', 'columns_not_null', 'close', 'close IS NULL')} UNION ALL {line('equity', 'table_row_count_between', '*', 'count(*) >= 1')})""")
def _(spark, d):
    """The gate of the published equity table as one report."""
    out = report(stage(spark, d).equity, GATES["stage_2.fact_market_equity"])
    return out.select("check", "column", "success", "element_count", "unexpected_count")


@query("dq_50_gate_blocks", "SELECT count(*) AS published, true AS refused FROM lineitem WHERE false")
def _(spark, d):
    """A frame that fails its gate is not published."""
    lines = M.table(spark, d, "lineitem")
    try:
        gate(lines, [("compound_columns_unique", {"column_list": ["l_orderkey", "l_linenumber"]})], "lineitem")
        refused = False
    except QualityError:
        refused = True
    return lines.where(F.lit(not refused)).agg(F.count(F.lit(1)).alias("published")).withColumn("refused", F.lit(refused))


@query("dq_05_orphan_gate", f"""WITH {S.EQUITY} SELECT count(*) AS element_count, count(*) FILTER (WHERE sid % 5 = 0) AS unexpected_count
FROM equity e JOIN stocks t ON t.symbol = e.symbol""")
def _(spark, d):
    """Orphans kept with a null key are caught by the not-null check of the master gate."""
    s = stage(spark, d)
    known = s.dim_stock.join(M.instruments(spark, d).where("sid % 5 <> 0").select("symbol"), "symbol", "left_semi")
    kept = lookups.resolve_fact_keys(s.equity.select("symbol", "trade_date", "close"), known, "stock_key", on_orphan="keep")
    return report(kept, [("column_not_null", {"column": "stock_key"})]).select("element_count", "unexpected_count")
