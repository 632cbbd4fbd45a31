"""Cleansing, labels, dimensions, write modes and sources on literal rows."""

from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from candlewright.functions import cleanse as C
from candlewright.functions import labels as L
from candlewright.operators import dims, lookups
from candlewright.operators.sector import sector_daily
from candlewright.sources import lifecycle, scan, writers
from candlewright.sources.files import exists


def test_dates_of_every_encoding(spark):
    for kind, value in (("date", date(2024, 1, 15)), ("bigint", 1705276800000), ("string", "2024-01-15T00:00:00")):
        df = spark.createDataFrame([(value,), (None,)], f"d {kind}")
        assert [r["d"] for r in C.with_date(df, "d").collect()] == [date(2024, 1, 15), None]
    assert C.with_date(spark.createDataFrame([("bad",), ("2024-13-01",)], "d string"), "d").where("d is not null").count() == 0


def test_bytes_lose_only_what_cannot_be_read(spark):
    df = spark.createDataFrame([(bytearray("Tăng".encode() + b"\xff\xfe!"),)], "b binary")
    assert df.select(C.decode_utf8("b").alias("t")).first()["t"] == "Tăng!"


def test_summary_schema_is_filled_and_typed(spark):
    df = spark.createDataFrame([(bytearray(b" hpg "), "2024-01-02", "1.5", "x")], "symbol binary, date string, pe string, pb string")
    row = C.normalise_summary(df).first()
    assert (row["symbol"], row["date"], row["pe"], row["pb"], row["beta"]) == ("HPG", "2024-01-02", 1.5, None, None)


def label(spark, expression, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'double'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(expression.alias("x")).first()["x"]


c = F.col


@pytest.mark.parametrize("value, want", [(30.0, "Quá bán"), (70.0, "Quá mua"), (50.0, "Trung tính"), (None, None)])
def test_rsi_label(spark, value, want):
    assert label(spark, L.rsi_label(c("v")), v=value) == want


@pytest.mark.parametrize("value, want", [(None, "Không có"), (0.0, "Không có"), (3.9, "Thấp"), (4.0, "Khá"), (8.0, "Khá"), (8.1, "Hấp dẫn")])
def test_dividend_label(spark, value, want):
    assert label(spark, L.dividend_label(c("v")), v=value) == want


@pytest.mark.parametrize("value, want", [(None, None), (9.9, "Yếu"), (10.0, "Trung bình"), (15.0, "Tốt"), (20.0, "Xuất sắc")])
def test_roe_label(spark, value, want):
    assert label(spark, L.roe_label(c("v")), v=value) == want


@pytest.mark.parametrize("pe, median, want", [(8.4, 10.0, "Rẻ"), (8.5, 10.0, "Hợp lý"), (11.5, 10.0, "Hợp lý"), (11.6, 10.0, "Đắt"),
                                              (-1.0, 10.0, "N/A"), (5.0, 0.0, "N/A"), (None, 10.0, "N/A"), (5.0, None, "N/A")])
def test_pe_label(spark, pe, median, want):
    assert label(spark, L.pe_label(c("p"), c("m")), p=pe, m=median) == want


@pytest.mark.parametrize("value, want", [(0.9, "Rẻ"), (1.0, "Hợp lý"), (3.0, "Hợp lý"), (3.1, "Đắt"), (0.0, "N/A"), (None, "N/A")])
def test_pb_label(spark, value, want):
    assert label(spark, L.pb_label(c("v")), v=value) == want


@pytest.mark.parametrize("close, high, low, want", [(8.0, 10.0, 0.0, "Gần đỉnh"), (2.0, 10.0, 0.0, "Gần đáy"), (5.0, 10.0, 0.0, "Trung bình"),
                                                    (5.0, 5.0, 5.0, None), (5.0, None, 1.0, None)])
def test_position_label(spark, close, high, low, want):
    assert label(spark, L.price_position_label(c("x"), c("h"), c("l")), x=close, h=high, l=low) == want


@pytest.mark.parametrize("rsi, macd, close, sma, want", [
    (35.0, "Tăng", 11.0, 10.0, "Mua mạnh"), (35.0, "Giảm", 11.0, 10.0, "Mua"), (70.0, "Giảm", 9.0, 10.0, "Bán mạnh"),
    (50.0, "Giảm", 9.0, 10.0, "Bán"), (50.0, "Tăng", 9.0, 10.0, "Nắm giữ"), (None, "Tăng", 11.0, 10.0, None)])
def test_trading_action(spark, rsi, macd, close, sma, want):
    assert label(spark, L.trading_action_label(c("r"), c("m"), c("x"), c("s")), r=rsi, m=macd, x=close, s=sma) == want


def test_unknown_macd_leaves_the_count_unknown(spark):
    df = spark.createDataFrame([(35.0, None, 11.0, 10.0)], "r double, m string, x double, s double")
    assert df.select(L.trading_action_label(c("r"), c("m"), c("x"), c("s")).alias("a")).first()["a"] == "Nắm giữ"


def test_sector_edges(spark):
    stocks = spark.createDataFrame([(1, "S"), (2, "S"), (3, "")], "stock_key int, sector string")
    sectors = spark.createDataFrame([(9, "S")], "sector_key int, sector string")
    facts = spark.createDataFrame(
        [(1, 20240101, 10.0, 5, None, 100.0, 10.0, -1.0, 1.0), (2, 20240101, 20.0, 1, 0.1, 300.0, None, 2.0, None), (3, 20240101, 1.0, 1, 1.0, 1.0, 1.0, 1.0, 1.0),
         (1, 20240102, 10.0, 5, 0.5, 0.0, None, None, None)],
        "stock_key int, date_key int, close double, total_volume bigint, price_change_pct double, market_cap double, pe double, pb double, eps double")
    a, b = sector_daily(facts, stocks, sectors).orderBy("date_key").collect()
    assert (a["price_change_pct"], a["total_trade_value"], a["avg_pe"], a["avg_pb"], a["avg_eps"], a["stock_count"]) == (
        pytest.approx(0.075), 70.0, pytest.approx(10.0), pytest.approx(2.0), 1.0, 2)
    assert b["price_change_pct"] is None and b["avg_pe"] is None


def test_surrogate_keys_extend_a_map_with_gaps(spark):
    mapping = spark.createDataFrame([("B", 7), ("X", 2)], "symbol string, stock_key int")
    now = spark.createDataFrame([("C",), ("A",), ("B",)], "symbol string")
    keyed, updated = dims.assign_surrogate_keys(now, mapping)
    assert {r["symbol"]: r["stock_key"] for r in keyed.collect()} == {"A": 8, "B": 7, "C": 9}
    again, same = dims.assign_surrogate_keys(now, updated)
    assert sorted(same.collect()) == sorted(updated.collect()) and updated.count() == 4


def test_ordered_numbers_over_many_partitions(spark):
    df = spark.range(1000).select(F.format_string("k%04d", "id").alias("k")).repartition(7)
    got = {r["k"]: r["_number"] for r in dims.ordered_numbers(df, "k").collect()}
    assert got == {f"k{i:04d}": i + 1 for i in range(1000)}


def scd(df):
    return sorted((r["symbol"], str(r["effective_from"]), str(r["effective_to"]), r["is_current"]) for r in df.collect())


def test_memberships_over_time(spark):
    snap = lambda *symbols: spark.createDataFrame([(s, 1) for s in symbols], "symbol string, index_id bigint")
    first = dims.merge_memberships(None, snap("A", "B"), date(2024, 1, 1))
    second = dims.merge_memberships(first, snap("B", "C"), date(2024, 2, 1))
    third = dims.merge_memberships(second, snap("A", "B"), date(2024, 3, 1))
    assert scd(third) == [("A", "2024-01-01", "2024-01-31", 0), ("A", "2024-03-01", "9999-12-31", 1),
                          ("B", "2024-01-01", "9999-12-31", 1), ("C", "2024-02-01", "2024-02-29", 0)]
    assert scd(dims.merge_memberships(third, snap("A", "B"), date(2024, 3, 1))) == scd(third)
    same_day = dims.merge_memberships(dims.merge_memberships(None, snap("A"), date(2024, 1, 1)), snap("B"), date(2024, 1, 1))
    assert scd(same_day) == [("B", "2024-01-01", "9999-12-31", 1)]
    legacy = first.drop("is_current")
    assert scd(dims.merge_memberships(legacy, snap("A"), date(2024, 2, 1))) == [
        ("A", "2024-01-01", "9999-12-31", 1), ("B", "2024-01-01", "2024-01-31", 0)]


def test_lookup_join_is_the_same_salted(spark):
    facts = spark.createDataFrame([("hot", 1)] * 50 + [("b", i) for i in range(5)] + [(None, 0)], "k string, v int")
    dim = spark.createDataFrame([("hot", 1.0), ("c", 2.0)], "k string, d double")
    for how in ("left", "inner"):
        a = lookups.lookup_join(facts, dim, ["k"], how)
        b = lookups.lookup_join(facts, dim, ["k"], how, broadcast_bytes=0)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_only_hot_keys_are_copied(spark):
    even = spark.range(4000).select((F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    hot = even.union(spark.range(2000).select(F.lit(7).alias("k"), F.col("id").alias("v"))).union(spark.range(9).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v")))
    dim = spark.range(900).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("d"))
    assert lookups.hot_keys(even, ["k"], 0.25) == [] and len(lookups.hot_keys(hot, ["k"], 0.25)) == 1
    plain = lookups.lookup_join(even, dim, ["k"], "left", broadcast_bytes=0)
    assert "_salt" not in plain._jdf.queryExecution().toString()
    for how in ("left", "inner"):
        got = lookups.lookup_join(hot, dim, ["k"], how, broadcast_bytes=0)
        assert sorted(map(str, got.collect())) == sorted(map(str, lookups.lookup_join(hot, dim, ["k"], how).collect()))
    salted = lookups.lookup_join(hot, dim, ["k"], "inner", broadcast_bytes=0)
    assert "_salt" in salted._jdf.queryExecution().toString()


def test_a_folder_of_drifting_types(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq
    from datetime import datetime

    moment = datetime(2024, 1, 5, 13, 30)
    columns = {
        "day=01/a": {"date": pa.array([date(2024, 1, 5)]), "v": pa.array([1], pa.int32())},
        "day=01/b": {"date": pa.array(["2024-01-05 10:00:00"]), "v": pa.array([2.5])},
        "day=02/c": {"date": pa.array([moment], pa.timestamp("ns")), "v": pa.array([3], pa.int64()), "at": pa.array([moment], pa.timestamp("ns"))},
        "day=02/d": {"date": pa.array([moment], pa.timestamp("us")), "only": pa.array(["x"])},
        "day=02/e": {"date": pa.array([1704450600000], pa.int64()), "only": pa.array([5])},
    }
    for name, cols in columns.items():
        path = tmp_path / f"{name}.parquet"
        path.parent.mkdir(exist_ok=True)
        pq.write_table(pa.table(cols), path)
    (tmp_path / "day=02/f.parquet").write_bytes(b"broken")
    (tmp_path / "day=02/notes.txt").write_text("other")
    got = scan.scan_drifting(spark, str(tmp_path))
    assert {f.name: f.dataType.simpleString() for f in got.schema}["date"] == "date" and set(got.columns) == {"date", "v", "at", "only", "day"}
    rows = got.select("date", "v", "only", F.col("at").cast("string").alias("at")).collect()
    assert {r["date"] for r in rows} == {date(2024, 1, 5)} and len(rows) == 5
    assert sorted(r["v"] for r in rows if r["v"] is not None) == [1.0, 2.5, 3.0] and sorted(r["only"] for r in rows if r["only"]) == ["5", "x"]
    assert [r["at"] for r in rows if r["at"]] == ["2024-01-05 13:30:00"]
    assert scan.scan_drifting(spark, str(tmp_path), "*.none").count() == 0


@pytest.mark.parametrize("pattern, partition", [("yyyy-MM-dd", "date"), ("yyyy-MM", "month")])
def test_expired_rows_leave_the_disk(spark, tmp_path, pattern, partition):
    import os

    path = str(tmp_path / "t")
    rows = spark.range(100).select(F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 86400).alias("t"), "id")
    rows.withColumn(partition, F.date_format("t", pattern)).union(spark.createDataFrame([(None, -1, None)], f"t timestamp, id long, {partition} string")).write.partitionBy(partition).parquet(path)
    status = lifecycle.expire(spark, path, "t", date(2024, 4, 1), 45, partition)
    kept = spark.read.parquet(path)
    # 2024-02-16 is the last day past its time: day 46 from the first of January.
    assert sorted(r["id"] for r in kept.collect()) == [-1, *range(47, 100)]
    assert set(status.values()) == ({"dropped"} if partition == "date" else {"dropped", "rewritten"}) and f"{partition}=2024-01-01" not in os.listdir(path)
    assert lifecycle.expire(spark, path, "t", date(2024, 4, 1), 45, partition) == {}


def test_merge_keeps_new_rows_and_padded_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    row = lambda *r: spark.createDataFrame([r], "symbol string, time string, v int")
    writers.write_by_day(row("A", "2024-01-05 10:00:00", 1).union(row("A", "2024-02-01 10:00:00", 5)), path)
    writers.write_by_day(row("A", "2024-01-05 10:00:00", 2).union(row("B", "2024-01-05 10:00:00", 3)), path)
    writers.write_by_day(row("A", "bad", 9), path)
    assert exists(spark, f"{path}/year=2024/month=01/day=05")
    assert sorted((r["symbol"], r["v"]) for r in spark.read.parquet(path).collect()) == [("A", 2), ("A", 5), ("B", 3)]
    writers.write_by_day(row("C", "2024-01-05 10:00:00", 8), path, append=False)
    assert spark.read.parquet(path).count() == 3


def test_key_choice_is_never_loose():
    assert writers.dedup_keys(["id", "symbol"], ["id"], ["symbol", "day"]) == ["id"]
    assert writers.dedup_keys(["day", "symbol"], ["id"], ["symbol", "day"]) == ["symbol", "day"]
    with pytest.raises(ValueError):
        writers.dedup_keys(["symbol"], ["id"], ["symbol", "day"])


def table_of(spark, columns, *rows):
    return spark.createDataFrame(list(rows), columns)


@pytest.mark.parametrize("parts", [[], ["y"]])
def test_merged_columns_are_the_same_in_all_partitions(spark, tmp_path, parts):
    """Columns in common without a guard, all of them with it, in touched and untouched partitions."""
    old = table_of(spark, "k string, y string, v int, old_only int", ("A", "01", 1, 5), ("B", "02", 2, 6))
    new = table_of(spark, "k string, y string, v int, new_only int", ("A", "01", 9, 7), ("C", "01", 3, 8))
    for guard, columns in ((False, ["k", "v", "y"]), (True, ["k", "new_only", "old_only", "v", "y"])):
        path = str(tmp_path / f"t{guard}")
        writers.append_merge(old, path, ["k"], parts, guard=guard)
        writers.append_merge(new, path, ["k"], parts, guard=guard)
        got = spark.read.parquet(path)
        assert sorted(got.columns) == columns
        assert sorted((r["k"], r["v"]) for r in got.collect()) == [("A", 9), ("B", 2), ("C", 3)]
        if guard:
            assert {r["k"]: (r["old_only"], r["new_only"]) for r in got.collect()} == {"A": (None, 7), "B": (6, None), "C": (None, 8)}


def test_keys_are_compared_after_the_transform(spark, tmp_path):
    path, tidy = str(tmp_path / "t"), lambda df: df.withColumn("k", F.upper(F.trim("k")))
    writers.append_merge(table_of(spark, "k string, v int", ("A", 1), ("b", 4)), path, ["k"], transform=tidy)
    writers.append_merge(table_of(spark, "k string, v int", (" a", 2)), path, ["k"], transform=tidy)
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [("A", 2), ("B", 4)]


def test_only_touched_partitions_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.append_merge(table_of(spark, "k string, y string, v int", ("A", "01", 1), ("B", "02", 2)), path, ["k", "y"], ["y"])
    broken = next((tmp_path / "t" / "y=02").glob("*.parquet"))
    broken.write_bytes(b"unreadable")
    writers.append_merge(table_of(spark, "k string, y string, v int", ("A", "01", 5)), path, ["k", "y"], ["y"])
    assert broken.read_bytes() == b"unreadable"


def test_newest_summary_row_wins(spark):
    from candlewright.functions.cleanse import one_per_key

    df = table_of(spark, "s string, ingested_at string, pe double", ("A", "2024-01-01", 9.0), ("A", "2024-01-03", 1.0), ("A", None, 99.0), ("B", None, None))
    got = sorted(map(tuple, one_per_key(df, ["s"], "ingested_at").collect()))
    assert got == [("A", "2024-01-03", 1.0), ("B", None, None)]


def test_latency_of_nothing_is_one_row(spark):
    from candlewright.operators.latency import latency_summary

    none = spark.createDataFrame([], "symbol string, candle_time timestamp, received_at timestamp")
    assert [(r["total"], r["p50_ms"]) for r in latency_summary(none).collect()] == [(0, None)]


def test_guard_treats_null_keys_as_equal(spark):
    old = spark.createDataFrame([("A", None), ("B", 1)], "k string, n int")
    assert writers.lost_keys(old, old, ["k", "n"]).isEmpty()
    assert writers.lost_keys(old, old.where("k = 'B'"), ["k", "n"]).count() == 1


def test_purge_needs_an_archive(spark, tmp_path):
    table, kept = str(tmp_path / "t"), str(tmp_path / "a")
    df = spark.createDataFrame([(f"2024-01-{i:02d} 10:00:00", i) for i in (1, 2, 30)], "t string, v int").withColumn("t", F.to_timestamp("t"))
    lifecycle.archive(df, "t", table)
    assert [r["status"] for r in lifecycle.archive(df, "t", kept, day="2024-01-01").collect()] == ["archived"]
    assert [r["status"] for r in lifecycle.archive(df, "t", kept, day="2024-01-01").collect()] == ["skipped"]
    status = lifecycle.purge_partitions(spark, table, kept, date(2024, 2, 10), 30)
    assert status == {"2024-01-01": "purged", "2024-01-02": "kept"}
    assert sorted(r["v"] for r in spark.read.parquet(table).collect()) == [2, 30]


def test_scan_skips_other_kinds_and_unreadable_files(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    for day, columns in (("01", {"symbol": ["A"], "close": [1.0]}), ("02", {"symbol": ["B"]})):
        folder = tmp_path / f"year=2024/month=01/day={day}"
        folder.mkdir(parents=True)
        pq.write_table(pa.table(columns), folder / "ohlc.parquet")
        pq.write_table(pa.table({"other": [1]}), folder / "summary.parquet")
    bad = tmp_path / "year=2024/month=01/day=03"
    bad.mkdir()
    (bad / "ohlc.parquet").write_bytes(b"not parquet")
    df = scan.scan_kind(spark, str(tmp_path), "ohlc.parquet")
    assert sorted((r["symbol"], r["close"]) for r in df.collect()) == [("A", 1.0), ("B", None)]
    assert scan.only_day(df, "2024-01-02").count() == 1


def test_optional_table_and_load(spark, tmp_path):
    schema = StructType([StructField("a", StringType()), StructField("d", DateType())])
    assert scan.optional_table(spark, str(tmp_path / "none"), schema).columns == ["a", "d"]
    df = spark.createDataFrame([(1, date(9999, 12, 31)), (2, None)], "x int, d date")
    assert writers.load_table(df, str(tmp_path / "t"), schema).first()["verified"]
    assert sorted(str(r["d"]) for r in spark.read.parquet(str(tmp_path / "t")).collect()) == ["2149-06-06", "None"]


def test_store_refuses_a_failing_table(spark, tmp_path):
    from candlewright.quality.suite import QualityError

    store = writers.Store(spark, str(tmp_path))
    good = spark.createDataFrame([(1, "S")], "sector_key int, sector string")
    store.publish(good, "master.dim_sector")
    with pytest.raises(QualityError):
        store.publish(good.union(good), "master.dim_sector")
    assert store.read("master.dim_sector").count() == 1
