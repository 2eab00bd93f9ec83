"""Reporting marts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import exact_mean, segment
from tidemark.schemas import CUSTOMER_SEGMENTS, PRODUCT_SEGMENTS


# What the daily mart reads of the facts.
DAILY_COLUMNS = {
    "fact_orders": ("order_key", "order_date", "order_total", "is_cancelled", "is_delivered"),
    "fact_payments": ("order_key", "amount", "is_captured", "is_refunded"),
    "fact_shipments": ("order_key", "is_packed", "is_shipped", "is_delivered", "hours_to_ship", "hours_to_deliver"),
}

# What the customer mart reads of the order fact, and what finds an order's customer version.
CUSTOMER_VALUE_COLUMNS = ("customer_id", "ordered_at", "order_total", "is_cancelled", "is_delivered")


def orders_in_scope(orders: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Orders whose date lies in the inclusive range; no range means all."""
    if (start is None) != (end is None):
        raise ValueError("both ends of the date range must be given")
    if start is None:
        return orders
    return orders.filter(F.col("order_date").between(F.lit(start), F.lit(end)))


def _sum_if(value: str, condition: Column) -> Column:
    return F.sum(F.when(condition, F.col(value)))


def daily_order_metrics(orders: DataFrame) -> DataFrame:
    cancelled = F.col("is_cancelled")
    return orders.groupBy("order_date").agg(
        F.count("*").alias("order_count"),
        F.count_if(~cancelled).alias("non_cancelled_order_count"),
        F.count_if(cancelled).alias("cancelled_order_count"),
        F.count_if("is_delivered").alias("delivered_order_count"),
        F.sum("order_total").alias("gross_order_value"),
        _sum_if("order_total", ~cancelled).alias("non_cancelled_order_value"),
        exact_mean(F.col("order_total")).alias("average_order_value"),
    )


def daily_payment_metrics(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments by the date of their order."""
    dated = payments.join(orders.select("order_key", "order_date"), "order_key")
    return dated.groupBy("order_date").agg(
        F.count("*").alias("payment_count"),
        F.count_if("is_captured").alias("captured_payment_count"),
        F.count_if("is_refunded").alias("refunded_payment_count"),
        F.sum("amount").alias("total_payment_value"),
        _sum_if("amount", F.col("is_captured")).alias("captured_payment_value"),
        _sum_if("amount", F.col("is_refunded")).alias("refunded_payment_value"),
    )


def daily_shipment_metrics(shipments: DataFrame, orders: DataFrame) -> DataFrame:
    """Shipments by the date of their order; hours are means of rounded hours."""
    dated = shipments.join(orders.select("order_key", "order_date"), "order_key")
    return dated.groupBy("order_date").agg(
        F.count("*").alias("shipment_count"),
        F.count_if("is_packed").alias("packed_shipment_count"),
        F.count_if("is_shipped").alias("shipped_shipment_count"),
        F.count_if("is_delivered").alias("delivered_shipment_count"),
        exact_mean(F.col("hours_to_ship")).alias("average_hours_to_ship"),
        exact_mean(F.col("hours_to_deliver")).alias("average_hours_to_deliver"),
    )


# Filled with 0 on days without payments or shipments; values of orders and
# average hours stay NULL.
_FILLED = (
    "payment_count", "captured_payment_count", "refunded_payment_count", "total_payment_value",
    "captured_payment_value", "refunded_payment_value", "shipment_count", "packed_shipment_count",
    "shipped_shipment_count", "delivered_shipment_count")


def mart_daily(
    orders: DataFrame, payments: DataFrame, shipments: DataFrame, start: date | None = None, end: date | None = None,
    run_id: str | None = None, refreshed_at: Column | None = None,
) -> DataFrame:
    """One row per order date in scope. Run id and refresh time are added only
    when a run id is given."""
    scope = orders_in_scope(orders, start, end)
    # one row per day on each side from here on
    merged = (
        daily_order_metrics(scope)
        .join(daily_payment_metrics(payments, scope), "order_date", "left")
        .join(daily_shipment_metrics(shipments, scope), "order_date", "left")
    )
    filled = merged.withColumns({name: F.coalesce(F.col(name), F.lit(0)) for name in _FILLED})
    if run_id is None:
        return filled
    return filled.withColumns({
        "orchestration_run_id": F.lit(run_id),
        "refreshed_at": F.current_timestamp() if refreshed_at is None else refreshed_at,
    })


def mart_customer_value(customers: DataFrame, orders: DataFrame, bands=CUSTOMER_SEGMENTS) -> DataFrame:
    """One row per current customer; cancelled orders count towards value."""
    cancelled = F.col("is_cancelled")
    metrics = orders.groupBy("customer_id").agg(
        F.count("*").alias("lifetime_order_count"),
        F.count_if(~cancelled).alias("non_cancelled_order_count"),
        F.count_if(cancelled).alias("cancelled_order_count"),
        F.count_if("is_delivered").alias("delivered_order_count"),
        F.sum("order_total").alias("lifetime_order_value"),
        exact_mean(F.col("order_total")).alias("average_order_value"),
        F.min("ordered_at").alias("first_order_at"),
        F.max("ordered_at").alias("most_recent_order_at"),
    )
    counted = (
        "lifetime_order_count", "non_cancelled_order_count", "cancelled_order_count", "delivered_order_count",
        "lifetime_order_value", "average_order_value")
    members = customers.filter(F.col("is_current") & ~F.col("is_deleted")).select(
        "customer_key", "customer_id", "full_name", "email", "city", "state_code", "customer_status")
    joined = members.join(metrics, "customer_id", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in counted})
    return joined.select(
        *members.columns, *counted, "first_order_at", "most_recent_order_at",
        segment(F.col("lifetime_order_value"), bands).alias("customer_value_segment"),
    )


def mart_product_performance(products: DataFrame, items: DataFrame, bands=PRODUCT_SEGMENTS) -> DataFrame:
    """One row per product.

    Lines are first added up per (product, order), so a hot product reaches the
    second step as one row per order and the distinct order count is a count.
    """
    per_order = items.groupBy("product_id", "order_id").agg(
        F.count("*").alias("lines"),
        F.sum("quantity").alias("units"),
        F.sum("line_total").alias("revenue"),
        F.sum("unit_price").alias("price_sum"),
        F.count("unit_price").alias("price_count"),
    )
    metrics = per_order.groupBy("product_id").agg(
        F.count("order_id").alias("order_count"),
        F.sum("lines").alias("order_line_count"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("gross_product_revenue"),
        F.round(
            F.sum("price_sum").cast("decimal(28,2)") / F.sum("price_count"), 2
        ).alias("average_selling_price"),
    )
    counted = (
        "order_count", "order_line_count", "units_sold", "gross_product_revenue", "average_selling_price")
    members = products.select(
        "product_key", "product_id", "sku", "product_name", "category", F.col("unit_price").alias("current_unit_price"),
        "is_active")
    joined = members.join(metrics, "product_id", "left").withColumns(
        {name: F.coalesce(F.col(name), F.lit(0)) for name in counted})
    return joined.select(
        *members.columns, *counted,
        segment(F.col("gross_product_revenue"), bands).alias("product_performance_segment"),
    )
