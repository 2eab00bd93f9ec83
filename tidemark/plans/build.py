"""From the raw table to history, dimensions, facts and marts."""

from __future__ import annotations

from collections.abc import Mapping, Set
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import checks as chk
from tidemark.operators import star
from tidemark.operators.current import current_from_raw
from tidemark.plans import marts
from tidemark.plans.refresh import HISTORY_SCHEMA, Build, customer_history
from tidemark.schemas import ACCEPTED_VALUES, CUSTOMER_SEGMENTS, ENTITIES, OPERATIONS, PRODUCT_SEGMENTS, TABLES
from tidemark.sources.lake import Lake


def build_current(raw: DataFrame) -> dict[str, DataFrame]:
    """Lazy current state of every entity; each prunes raw to its own table."""
    return {name: current_from_raw(raw, name) for name in ENTITIES}


def build_star(current: Mapping[str, DataFrame], history: DataFrame) -> dict[str, DataFrame]:
    customers, products = star.dim_customers(history), star.dim_products(current["products"])
    return {
        "dim_customers": customers,
        "dim_products": products,
        "fact_orders": star.fact_orders(current["orders"], customers),
        "fact_order_items": star.fact_order_items(current["order_items"], products),
        "fact_payments": star.fact_payments(current["payments"]),
        "fact_shipments": star.fact_shipments(current["shipments"]),
    }


def build_marts(tables: Mapping[str, DataFrame], start: date | None = None, end: date | None = None,
                run_id: str = "manual") -> dict[str, DataFrame]:
    return {
        "mart_daily_commerce": marts.mart_daily(
            tables["fact_orders"], tables["fact_payments"], tables["fact_shipments"], start, end, run_id),
        "mart_customer_value": marts.mart_customer_value(tables["dim_customers"], tables["fact_orders"]),
        "mart_product_performance": marts.mart_product_performance(
            tables["dim_products"], tables["fact_order_items"]),
    }


def build_all(lake: Lake, run_id: str, snapshot_at: datetime, start: date | None = None,
              end: date | None = None) -> dict[str, DataFrame]:
    """Brings every table up to date and publishes them; see :mod:`tidemark.plans.refresh`."""
    build = Build(lake, run_id, snapshot_at, start, end)
    written = build.run()
    build.publish()
    return written


def data_tests(raw: DataFrame, t: Mapping[str, DataFrame], changed: Set[str] | None = None) -> list[chk.DataTest]:
    """Every data test, or those that look at a ``changed`` table. ``t`` maps table names to frames: current_*,
    snap_customers, dim_*, fact_*, mart_*."""
    def looked_at(*tables: str) -> bool:
        return changed is None or not changed.isdisjoint(tables)

    normal = raw.withColumn("record_json", F.coalesce(
        F.nullif("after_json", F.lit("")), F.nullif("before_json", F.lit(""))))
    frames = {**t, "bronze_events": normal, "stg_bronze_events": normal}
    tests: list[chk.DataTest] = []

    def unique(table: str, *columns: str) -> None:
        if looked_at(table):
            tests.extend(chk.DataTest("unique", table, c, frames[table]) for c in columns)

    def filled(table: str, *columns: str) -> None:
        if looked_at(table):
            tests.extend(chk.DataTest("not_null", table, c, frames[table]) for c in columns)

    def related(child: str, column: str, parent: str) -> None:
        if looked_at(child, parent):
            tests.append(chk.DataTest("relationships", child, column, frames[child], parent=frames[parent]))

    def listed(table: str, column: str, values) -> None:
        if looked_at(table):
            tests.append(chk.DataTest("accepted_values", table, column, frames[table], values=tuple(values)))

    metadata = ("event_id", "operation", "source_table", "kafka_topic", "kafka_partition", "kafka_offset")
    unique("bronze_events", "event_id")
    filled("bronze_events", *metadata)
    unique("stg_bronze_events", "event_id")
    filled("stg_bronze_events", *metadata, "record_json")
    listed("stg_bronze_events", "operation", OPERATIONS)
    listed("stg_bronze_events", "source_table", TABLES)

    for name, entity in ENTITIES.items():
        unique(f"current_{name}", entity.key)
        filled(f"current_{name}", entity.key)
    related("current_orders", "customer_id", "current_customers")
    related("current_order_items", "order_id", "current_orders")
    related("current_order_items", "product_id", "current_products")
    related("current_payments", "order_id", "current_orders")
    related("current_shipments", "order_id", "current_orders")
    for (table, column), values in ACCEPTED_VALUES.items():
        listed(f"current_{table}", column, values)

    unique("snap_customers", "scd_id")
    filled("snap_customers", "scd_id", "customer_id", "valid_from", "is_deleted")

    unique("dim_customers", "customer_key")
    filled("dim_customers", "customer_key", "customer_id")
    unique("dim_products", "product_key", "product_id")
    filled("dim_products", "product_key", "product_id")
    unique("fact_orders", "order_key", "order_id")
    filled("fact_orders", "order_key", "order_id", "customer_key")
    related("fact_orders", "customer_key", "dim_customers")
    unique("fact_order_items", "order_item_key", "order_item_id")
    filled("fact_order_items", "order_item_key", "order_item_id", "order_key", "product_key")
    related("fact_order_items", "order_key", "fact_orders")
    related("fact_order_items", "product_key", "dim_products")
    unique("fact_payments", "payment_key", "payment_id")
    filled("fact_payments", "payment_key", "payment_id", "order_key")
    related("fact_payments", "order_key", "fact_orders")
    unique("fact_shipments", "shipment_key", "shipment_id")
    filled("fact_shipments", "shipment_key", "shipment_id", "order_key")
    related("fact_shipments", "order_key", "fact_orders")

    unique("mart_daily_commerce", "order_date")
    filled("mart_daily_commerce", "order_date")
    unique("mart_customer_value", "customer_id", "customer_key")
    filled("mart_customer_value", "customer_id", "customer_key")
    listed("mart_customer_value", "customer_value_segment", [n for n, _ in CUSTOMER_SEGMENTS])
    unique("mart_product_performance", "product_id", "product_key")
    filled("mart_product_performance", "product_id", "product_key")
    listed("mart_product_performance", "product_performance_segment", [n for n, _ in PRODUCT_SEGMENTS])

    facts = [t[n] for n in ("fact_orders", "fact_payments", "fact_shipments", "mart_daily_commerce")]
    singular = {
        "history_has_no_overlap": (chk.history_overlaps(t["snap_customers"]), ["snap_customers"]),
        "one_open_version": (chk.not_one_open_version(t["snap_customers"]), ["snap_customers"]),
        "item_totals_match": (chk.item_totals_differ(t["fact_orders"], t["fact_order_items"]), ["fact_orders", "fact_order_items"]),
        "payment_totals_match": (chk.payment_totals_differ(t["fact_orders"], t["fact_payments"]), ["fact_orders", "fact_payments"]),
        "daily_mart_reconciles": (
            chk.daily_mart_differs(*facts), ["fact_orders", "fact_payments", "fact_shipments", "mart_daily_commerce"]),
    }
    tests.extend(chk.DataTest("singular", name, None, failing) for name, (failing, of) in singular.items() if looked_at(*of))
    return tests


__all__ = ["HISTORY_SCHEMA", "build_all", "build_current", "build_marts", "build_star", "customer_history", "data_tests"]
