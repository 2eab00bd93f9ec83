from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.operators import policy
from tidemark.operators.aggregates import fingerprint
from tidemark.operators.audit import RunWindow
from tidemark.operators.checks import daily_mart_differs, dataset_problems, payment_totals_differ, row_rules, broken_rows
from tidemark.plans.marts import mart_daily
from tidemark.plans.profiles import check_summary, overall_status
from tidemark.schemas import CUSTOMERS
from tidemark.sources.jdbc import Jdbc
from tidemark.sources.records import kafka_options, topics

T0 = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def drift(spark, record, table="customers"):
    text = record if isinstance(record, str) else json.dumps(record)
    frame = spark.createDataFrame([(table, text)], "source_table string, record_json string")
    r = policy.schema_drift(frame).first()
    return r["compatible"], r["change_type"], r["drift_reason"], r["missing_fields"], r["extra_fields"]


def test_schema_drift_cases(spark):
    full = {c: "x" for c in CUSTOMERS.columns} | {"customer_id": 1}
    no_key = {k: v for k, v in full.items() if k != "customer_id"}
    no_email = {k: v for k, v in full.items() if k != "email"}
    assert drift(spark, full) == (True, "unchanged", None, [], [])
    assert drift(spark, full | {"loyalty_tier": "gold"}) == (True, "additive", None, [], ["loyalty_tier"])
    assert drift(spark, no_key) == (False, "incompatible", "missing_primary_key", ["customer_id"], [])
    for wrong in ("1", True, None, 1.5):
        assert drift(spark, full | {"customer_id": wrong})[2] == "incompatible_primary_key_type"
    assert drift(spark, no_email) == (False, "incompatible", "missing_expected_fields", ["email"], [])
    assert drift(spark, full, "other") == (False, "incompatible", "unexpected_source_table", [], [])
    assert drift(spark, "[1]")[2:4] == ("record_not_object", sorted(CUSTOMERS.columns))
    assert drift(spark, "not json")[2] == "record_not_object"


@pytest.mark.parametrize("offset, status, late, delay", [
    (1, "on_time", False, 0), (-60, "out_of_order", False, 60), (-7200, "late", True, 7200),
    (-300, "out_of_order", False, 300), (-300.001, "late", True, Decimal("300.001"))])
def test_lateness(spark, offset, status, late, delay):
    event, mark = policy.utc_literal(T0 + timedelta(seconds=offset)), policy.utc_literal(T0)
    r = spark.range(1).select(*[c.alias(n) for n, c in policy.order_class(event, mark).items()]).first()
    assert (r["order_status"], r["requires_backfill"], r["event_delay_seconds"]) == (status, late, delay)


def test_lateness_must_not_be_negative():
    with pytest.raises(ValueError):
        policy.order_class(F.lit(1), F.lit(1), -1)


def test_event_order_in_small_blocks(spark, sf_dir):
    from tidemark.catalog.queries import _with_lateness

    events = _with_lateness(spark, sf_dir)
    columns = ["kafka_offset", "order_status", "event_delay_seconds"]
    small, large = policy.event_order(events, block_size=16), policy.event_order(events)
    assert small.select(*columns).exceptAll(large.select(*columns)).isEmpty()
    assert policy.out_of_order(events, block_size=16).count() == policy.out_of_order(events).count()


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "table_name string, row_count long")


def test_reconciliation(spark):
    rows = policy.reconcile_counts(
        counts(spark, ("a", 5), ("b", 5), ("c", 1)), counts(spark, ("a", 5), ("b", 3), ("d", 2))).orderBy("table_name")
    assert [tuple(r)[3:] for r in rows.collect()] == [
        (0, 0, 0, True), (-2, 2, 0, False), (-1, 1, 0, False), (2, 0, 2, False)]
    with pytest.raises(PySparkException):
        policy.reconcile_counts(counts(spark, ("a", -1)), counts(spark, ("a", 1))).collect()


def test_freshness_and_recovery(spark):
    def value(column):
        return spark.range(1).select(column).first()[0]

    later = T0 + timedelta(seconds=97, microseconds=584_400)
    assert value(policy.freshness(policy.utc_literal(T0), policy.utc_literal(later))) == Decimal("97.584")
    assert value(policy.freshness(policy.utc_literal(later), policy.utc_literal(T0))) == 0
    assert value(policy.recovery(policy.utc_literal(T0), policy.utc_literal(later))) == Decimal("97.584")
    with pytest.raises(PySparkException):
        value(policy.recovery(policy.utc_literal(later), policy.utc_literal(T0)))
    with pytest.raises(ValueError):
        policy.utc_literal(datetime(2024, 1, 1))


def test_change_sequences(spark):
    events = spark.createDataFrame(
        [(1, 1, "c"), (1, 2, "u"), (1, 3, "d"), (2, 1, "c"), (2, 2, "d"), (3, 1, "c"), (3, 2, "u"), (3, 3, "d"),
         (3, 4, "c"), (4, 3, "d"), (4, 2, "u"), (4, 1, "c")], "k int, kafka_offset long, operation string"
    ).withColumn("event_id", F.lit("e"))
    left = spark.createDataFrame([(4,)], "k int")
    got = {r["k"]: (r["first_operations"], r["event_count"], r["verified"]) for r in policy.change_sequence(events, "k", remaining=left).collect()}
    assert got == {1: ("c,u,d", 3, True), 2: ("c,d", 2, False), 3: ("c,u,d", 4, False), 4: ("c,u,d", 3, False)}


@pytest.mark.parametrize("conf, expected", [
    (None, ("incremental", None, None)), ({}, ("incremental", None, None)),
    ({"run_mode": " Backfill ", "start_date": "2024-01-01", "end_date": "2024-01-31"},
     ("backfill", date(2024, 1, 1), date(2024, 1, 31))),
    ({"run_mode": "backfill", "backfill_start_date": date(2024, 1, 1), "backfill_end_date": datetime(2024, 1, 2)},
     ("backfill", date(2024, 1, 1), date(2024, 1, 2)))])
def test_run_arguments(conf, expected):
    window = RunWindow.told(conf)
    assert (window.mode, window.first, window.last) == expected


@pytest.mark.parametrize("conf, message", [
    ({"run_mode": "full"}, "either incremental or backfill"),
    ({"start_date": "2024-01-01"}, "must not include"),
    ({"run_mode": "backfill", "start_date": "2024-01-01"}, "require both"),
    ({"run_mode": "backfill", "start_date": "2024-01-02", "end_date": "2024-01-01"}, "must not be after"),
    ({"run_mode": "backfill", "start_date": "2024-01-01", "end_date": "2024-02-01"}, "cannot exceed 31"),
    ({"run_mode": "backfill", "start_date": "1 Jan", "end_date": "2024-02-01"}, "YYYY-MM-DD")])
def test_bad_run_arguments(conf, message):
    with pytest.raises(ValueError, match=message):
        RunWindow.told(conf)


def test_longer_windows_can_be_allowed():
    assert RunWindow(date(2024, 1, 1), date(2024, 3, 31), most=100).mode == "backfill"
    with pytest.raises(ValueError, match="require both"):
        RunWindow(first=date(2024, 1, 1))


def test_daily_mart_edges(spark):
    orders = spark.createDataFrame(
        [("a", date(2024, 1, 1), Decimal("5.00"), True), ("b", date(2024, 1, 2), Decimal("3.00"), False)],
        "order_key string, order_date date, order_total decimal(14,2), is_cancelled boolean"
    ).withColumn("is_delivered", ~F.col("is_cancelled"))
    payments = spark.createDataFrame(
        [("b", Decimal("3.00"), True, False)],
        "order_key string, amount decimal(14,2), is_captured boolean, is_refunded boolean")
    shipments = spark.createDataFrame(
        [], "order_key string, is_packed boolean, is_shipped boolean, is_delivered boolean, "
            "hours_to_ship decimal(14,2), hours_to_deliver decimal(14,2)")
    mart = mart_daily(orders, payments, shipments)
    first, second = mart.orderBy("order_date").collect()
    # only cancelled orders: no other value, no payments, no hours
    assert first["non_cancelled_order_value"] is None and first["total_payment_value"] == 0
    assert first["payment_count"] == 0 and first["average_hours_to_ship"] is None
    assert second["captured_payment_value"] == Decimal("3.00") and second["refunded_payment_value"] == 0
    assert daily_mart_differs(orders, payments, shipments, mart).isEmpty()
    assert daily_mart_differs(orders, payments, shipments, mart.filter("payment_count > 0")).count() == 1
    keyed = orders.withColumn("order_id", F.col("order_key"))
    assert [r["order_id"] for r in payment_totals_differ(keyed, payments).collect()] == ["a"]


def test_row_rules_let_null_pass(spark):
    rows = spark.createDataFrame(
        [(1, Decimal("0.00")), (2, None), (3, Decimal("1.00"))], "product_id long, unit_price decimal(14,2)")
    assert [tuple(r) for r in broken_rows(rows, "product_id", row_rules()["products"]).collect()] == [("1", "price")]


def test_dataset_problems_on_clean_and_broken_data(spark, sf_dir):
    from tidemark.sources import tables

    data = tables.entities(spark, sf_dir)
    sums = data["order_items"].groupBy("order_id").agg(
        F.sum(F.col("unit_price") * F.col("quantity")).alias("t"))
    data["orders"] = data["orders"].join(sums, "order_id", "left").withColumn(
        "order_total", F.coalesce("t", F.lit(0)).cast("decimal(14,2)")).drop("t")
    data["payments"] = data["payments"].drop("amount").join(
        data["orders"].select("order_id", F.col("order_total").alias("amount")), "order_id")
    data["order_items"] = data["order_items"].dropDuplicates(["order_item_id"])
    kinds = {r["problem"] for r in dataset_problems(data).select("problem").distinct().collect()}
    assert kinds == {"order repeats product"}
    data["payments"] = data["payments"].unionByName(data["payments"])
    data["customers"] = data["customers"].unionByName(data["customers"].filter("customer_id = 3"))
    kinds = {r["problem"] for r in dataset_problems(data).select("problem").distinct().collect()}
    assert kinds == {"order repeats product", "order with several payments", "duplicate customer id"}


def test_fingerprint_ignores_order_but_not_content(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    shuffled = spark.createDataFrame([(2, None), (1, "a")], "k int, v string")
    doubled = rows.unionByName(rows.filter("k = 1"))
    a, b, c = (fingerprint(f, ["k", "v"]).first() for f in (rows, shuffled, doubled))
    assert a == b != c


def test_no_checks_is_not_healthy(spark):
    none = spark.createDataFrame([], "check_name string, passed boolean")
    good = spark.createDataFrame([("a", True)], "check_name string, passed boolean")
    assert check_summary(none).first()["all_passed"] is False
    assert overall_status({"x": good, "y": none}).first()[0] == "attention_required"
    assert overall_status({"x": good}).first()[0] == "healthy"


def test_connector_options():
    assert topics("p", ["a", "b"]) == ["p.a", "p.b"]
    options = kafka_options("h:1", ["p.a", "p.b"])
    assert options["subscribe"] == "p.a,p.b" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "true" and options["maxOffsetsPerTrigger"] == "100000"
    read = Jdbc("jdbc:x", "u", "p").read_options("SELECT 1", "id", 0, 100, 8)
    assert read["dbtable"] == "(SELECT 1) AS warehouse_query" and read["numPartitions"] == "8"
