"""Current state, history merges, as-of lookups, keyed replacement."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.measures import exact_mean
from tidemark.operators.checks import history_overlaps, not_one_open_version
from tidemark.operators.dedup import dedup_events
from tidemark.operators.joins import lookup, missing_keys
from tidemark.operators.ordered import offset_block, with_previous, with_running_max
from tidemark.plans.marts import orders_in_scope
from tidemark.session import scratch_path
from tidemark.sources.lake import HistoryTable, Lake, read_optional, replace_rows
from tidemark.operators.current import latest_per_key

DAY = [datetime(2024, 1, n) for n in range(1, 29)]


def test_a_delete_hides_its_key_until_it_returns(spark):
    events = spark.createDataFrame(
        [(1, 10, "c"), (1, 20, "d"), (2, 10, "c"), (2, 20, "d"), (2, 30, "c"), (3, None, "c"), (3, 5, "u")],
        "k int, source_timestamp_ms long, op string").withColumns({
            "kafka_timestamp": F.lit(None).cast("timestamp"), "kafka_offset": F.lit(0), "event_id": F.lit("e")})
    rows = {(r["k"], r["op"]) for r in latest_per_key(events, ["k"]).collect()}
    assert rows == {(1, "d"), (2, "c"), (3, "u")}
    assert "WindowGroupLimit" in latest_per_key(events, ["k"])._jdf.queryExecution().toString()


def test_dedup_keeps_the_first_delivery(spark):
    events = spark.createDataFrame(
        [("a", DAY[2], "late"), ("a", DAY[1], "first"), ("b", DAY[1], "only")],
        "event_id string, ingested_at timestamp, ingestion_run_id string")
    assert {tuple(r) for r in dedup_events(events).select("event_id", "ingestion_run_id").collect()} == {
        ("a", "first"), ("b", "only")}


SCHEMA = T.StructType([
    T.StructField("customer_id", T.LongType()), T.StructField("city", T.StringType()),
    T.StructField("updated_at", T.TimestampType())])


def test_history_over_four_merges(spark):
    table = HistoryTable(spark, scratch_path(spark, "history"), SCHEMA, "customer_id")

    def merge(moment, *rows):
        table.merge(spark.createDataFrame(list(rows), SCHEMA), F.lit(moment).cast("timestamp"))
        history = table.read()
        assert history_overlaps(history).count() == 0 and not_one_open_version(history).count() == 0
        return sorted((r["customer_id"], r["city"], r["valid_from"].day, r["valid_to"] and r["valid_to"].day,
                       r["is_deleted"]) for r in history.collect())

    first = merge(DAY[4], (1, "a", DAY[0]), (2, "b", DAY[0]))
    assert first == [(1, "a", 1, None, False), (2, "b", 1, None, False)]
    # an update, and a row that did not move
    second = merge(DAY[9], (1, "A", DAY[6]), (2, "changed silently", DAY[0]))
    assert second == [(1, "A", 7, None, False), (1, "a", 1, 7, False), (2, "b", 1, None, False)]
    # 2 disappears, and stays away
    third = merge(DAY[14], (1, "A", DAY[6]))
    assert third[-2:] == [(2, "b", 1, 15, False), (2, "b", 15, None, True)]
    assert merge(DAY[15], (1, "A", DAY[6])) == third
    # 2 returns with an older time than its delete: no overlap, no gap
    back = merge(DAY[19], (1, "A", DAY[6]), (2, "c", DAY[9]))
    assert back[-3:] == [(2, "b", 1, 15, False), (2, "b", 15, 15, True), (2, "c", 15, None, False)]
    assert table.read().count() == table.read().select("scd_id").distinct().count()


def test_an_uncommitted_merge_is_invisible_and_overwritten(spark):
    path = scratch_path(spark, "history")
    table = HistoryTable(spark, path, SCHEMA, "customer_id")
    table.merge(spark.createDataFrame([(1, "a", DAY[0])], SCHEMA), F.lit(DAY[4]).cast("timestamp"))
    # what a merge leaves that died before its commit
    (table.read().withColumns({"is_open": F.lit(True), "city": F.lit("half done")})
     .write.partitionBy("is_open").parquet(f"{path}/versions/merge_id=2"))
    assert [r["city"] for r in table.read().collect()] == ["a"]
    table.merge(spark.createDataFrame([(1, "b", DAY[6])], SCHEMA), F.lit(DAY[9]).cast("timestamp"))
    assert sorted(r["city"] for r in table.read().collect()) == ["a", "b"]


def test_overlaps_and_open_versions_are_found(spark):
    history = spark.createDataFrame(
        [(1, DAY[0], DAY[9], "x"), (1, DAY[4], None, "y"), (2, DAY[0], None, "z"), (2, DAY[1], None, "w")],
        "customer_id long, valid_from timestamp, valid_to timestamp, scd_id string")
    assert {r["customer_id"] for r in history_overlaps(history).collect()} == {1, 2}
    assert [tuple(r) for r in not_one_open_version(history).collect()] == [(2, 2)]


def test_lookup_equals_a_plain_join_on_skewed_and_null_keys(spark):
    left = spark.range(4000).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 7 == 1, None).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = lookup(left, right, "k").select("id", "k", "v")
        plain = left.join(right, "k", "left").select("id", "k", "v")
        assert found.count() == 4000 and found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_missing_keys_are_counted(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in missing_keys(child, "k", parent, "id").collect()] == [(1, 2)]


@pytest.mark.parametrize("size", [1, 3, 10, 1000])
def test_blocked_windows_equal_plain_ones(spark, size):
    rows = spark.range(200).select(
        (F.col("id") % 2).alias("g"), (F.col("id") * 3).alias("o"), (F.col("id") * 7919 % 101).alias("v"))
    w = Window.partitionBy("g").orderBy("o")
    block = offset_block("o", size)
    got = with_previous(rows, ["g"], "o", "v", block, "x")
    assert got.exceptAll(rows.withColumn("x", F.lag("v").over(w)).select(*got.columns)).isEmpty()
    led = with_previous(rows, ["g"], "o", "v", block, "x", descending=True)
    assert led.exceptAll(rows.withColumn("x", F.lead("v").over(w)).select(*led.columns)).isEmpty()
    top = with_running_max(rows, ["g"], "o", "v", block, "x")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    assert top.exceptAll(rows.withColumn("x", F.max("v").over(before)).select(*top.columns)).isEmpty()
    assert got.count() == led.count() == top.count() == 200


def test_means_are_rounded_once(spark):
    # 999,999 values whose mean lies just below half a cent
    values = spark.range(999_999).select(
        F.when(F.col("id") < 499_999, F.lit("1.01")).otherwise("1.00").cast("decimal(14,2)").alias("x"))
    assert values.agg(exact_mean(F.col("x"))).first()[0] == Decimal("1.00")


def test_scope_needs_both_ends(spark):
    with pytest.raises(ValueError):
        orders_in_scope(spark.range(1), date(2024, 1, 1), None)


def test_replacement_by_key_on_disk(spark):
    lake = Lake(spark, scratch_path(spark, "lake"))
    month = F.trunc("day", "month")

    def put(rows, schema="day date, n int"):
        lake.replace_by_key(spark.createDataFrame(rows, schema), "marts", "daily", "day", "month", month)
        return {r["day"]: r.asDict() for r in lake.read("marts", "daily").drop("month").collect()}

    put([(date(2024, 1, 1), 1), (date(2024, 1, 2), 1), (date(2024, 2, 1), 1)])
    # only the given day changes; a day that vanished keeps its row; repeatable
    for _ in range(2):
        days = put([(date(2024, 1, 2), 2)])
        assert {d.isoformat(): r["n"] for d, r in days.items()} == {
            "2024-01-01": 1, "2024-01-02": 2, "2024-02-01": 1}
    # a column more, then a column less
    days = put([(date(2024, 2, 1), 3, "x")], "day date, n int, note string")
    assert days[date(2024, 1, 1)] == {"day": date(2024, 1, 1), "n": 1, "note": None}
    assert days[date(2024, 2, 1)]["note"] == "x" and len(days) == 3
    days = put([(date(2024, 1, 1), "y")], "day date, note string")
    assert days[date(2024, 1, 1)] == {"day": date(2024, 1, 1), "note": "y"} and len(days) == 3


def test_replace_rows_keeps_other_keys(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert {tuple(r) for r in replace_rows(old, new, "k").collect()} == {(1, "a"), (2, "B"), (3, "C")}


def test_absent_tables_read_as_empty(spark, tmp_path):
    assert read_optional(spark, str(tmp_path / "none"), SCHEMA).count() == 0
    (tmp_path / "empty").mkdir()
    assert read_optional(spark, str(tmp_path / "empty"), SCHEMA).count() == 0


def test_history_keeps_a_change_dated_before_the_delete(spark):
    from datetime import datetime

    from tidemark.operators.scd2 import merge_versions

    schema = "k int, v string, updated_at timestamp"
    at = lambda day: datetime(2024, 1, day)
    history = spark.createDataFrame([], schema + ", scd_id string, valid_from timestamp, valid_to timestamp, is_deleted boolean")
    closed = []
    for day, rows in ((5, [(1, "a", at(1)), (2, "n", None)]), (15, [(2, "n", None)]), (16, [(1, "b", at(10)), (2, "n", None)]),
                      (17, [(1, "c", at(12)), (2, "m", None)])):
        merged = merge_versions(history, spark.createDataFrame(rows, schema), F.lit(at(day)), "k").collect()
        closed += [r for r in merged if r["valid_to"] is not None]
        history = spark.createDataFrame([r for r in merged if r["valid_to"] is None], history.schema)
    rows = closed + history.collect()
    assert {(r["k"], r["v"]) for r in history.collect()} == {(1, "c"), (2, "m")}
    for k in (1, 2):
        mine = sorted((r for r in rows if r["k"] == k), key=lambda r: r["valid_from"])
        assert all(a["valid_to"] is not None and a["valid_to"] <= b["valid_from"] for a, b in zip(mine, mine[1:]))
