"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key, version_key
from tidemark.functions.measures import hours_between
from tidemark.operators.asof import as_of
from tidemark.operators.joins import lookup
from tidemark.schemas import STAR_TAIL


def dim_customers(history: DataFrame) -> DataFrame:
    deleted = F.coalesce(F.col("is_deleted"), F.lit(False))
    return history.select(
        version_key(F.col("customer_id"), F.col("valid_from")).alias("customer_key"),
        "customer_id", "first_name", "last_name",
        # NULL if either part is
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email", "city", "state_code", "customer_status", "created_at", "updated_at", "valid_from", "valid_to",
        deleted.alias("is_deleted"),
        (F.col("valid_to").isNull() & ~deleted).alias("is_current"),
        *STAR_TAIL,
    )


def dim_products(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key(F.col("product_id")).alias("product_key"),
        "product_id", "sku", "product_name", "category", "unit_price", F.col("active").alias("is_active"),
        "created_at", "updated_at", *STAR_TAIL,
    )


def fact_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with the key of the customer version valid when they were placed."""
    return order_facts(with_customer_key(orders, customers), "customer_key")


def with_customer_key(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, or columns of the fact, with that key.

    A history has at most two rows per key and merge, so the residual range
    test sees few versions per order; partitions of heavy customers are split.
    """
    versions = customers.filter(~F.col("is_deleted")).select(
        "customer_id", "customer_key", "valid_from", "valid_to")
    as_of = (F.col("l.ordered_at") >= F.col("r.valid_from")) & (
        F.col("r.valid_to").isNull() | (F.col("l.ordered_at") < F.col("r.valid_to")))
    return lookup(orders, versions, "customer_id", condition=as_of)


def fact_orders_interleaved(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """The same where a customer may have very many versions and orders: no order
    is compared with a version that was not the last to begin before it."""
    versions = customers.filter(~F.col("is_deleted")).select("customer_id", "customer_key", "valid_from", "valid_to")
    return order_facts(as_of(orders, versions, "customer_id", "ordered_at", ["customer_key"]), "customer_key")


def order_facts(orders: DataFrame, *keys: str) -> DataFrame:
    """What the fact has without looking anything up, plus ``keys``: enough for
    daily totals, payments, shipments and reconciliation."""
    return orders.select(
        surrogate_key(F.col("order_id")).alias("order_key"),
        *keys, "order_id", "customer_id", "order_status", "order_total", "currency", "ordered_at",
        F.to_date("ordered_at").alias("order_date"),
        F.trunc(F.to_date("ordered_at"), "month").alias("order_month"),
        (F.col("order_status") == "cancelled").alias("is_cancelled"),
        (F.col("order_status") == "delivered").alias("is_delivered"),
        *STAR_TAIL,
    )


def fact_order_items(items: DataFrame, products: DataFrame) -> DataFrame:
    keys = products.select("product_id", "product_key")
    return item_facts(lookup(items, keys, "product_id"), "product_key")


def item_facts(items: DataFrame, *keys: str) -> DataFrame:
    """What the fact has without looking anything up, plus ``keys``."""
    return items.select(
        surrogate_key(F.col("order_item_id")).alias("order_item_key"),
        surrogate_key(F.col("order_id")).alias("order_key"),
        *keys, "order_item_id", "order_id", "product_id", "quantity", "unit_price", "line_total",
        *STAR_TAIL,
    )


def fact_payments(payments: DataFrame) -> DataFrame:
    status = F.col("payment_status")
    return payments.select(
        surrogate_key(F.col("payment_id")).alias("payment_key"),
        surrogate_key(F.col("order_id")).alias("order_key"),
        "payment_id", "order_id", "payment_status", "payment_method", "amount", "paid_at", "created_at", "updated_at",
        *[(status == s).alias(f"is_{s}") for s in ("authorized", "captured", "refunded", "pending")],
        *STAR_TAIL,
    )


def fact_shipments(shipments: DataFrame) -> DataFrame:
    status = F.col("shipment_status")
    return shipments.select(
        surrogate_key(F.col("shipment_id")).alias("shipment_key"),
        surrogate_key(F.col("order_id")).alias("order_key"),
        "shipment_id", "order_id", "shipment_status", "carrier", "tracking_code", "shipped_at", "delivered_at",
        "created_at", "updated_at",
        *[(status == s).alias(f"is_{s}") for s in ("packed", "shipped", "delivered")],
        hours_between(F.col("created_at"), F.col("shipped_at")).alias("hours_to_ship"),
        hours_between(F.col("created_at"), F.col("delivered_at")).alias("hours_to_deliver"),
        *STAR_TAIL,
    )
