"""Data tests. A check is a frame of failing rows; no rows means it holds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import one_row
from tidemark.operators.joins import dealt, missing_keys
from tidemark.operators.ordered import with_previous
from tidemark.schemas import MONEY_TOLERANCE, SOURCE_VALUES


def unique(rows: DataFrame, *columns: str) -> DataFrame:
    """Values that occur more than once; NULLs are not compared."""
    present = rows.dropna(subset=list(columns))
    return present.groupBy(*columns).agg(F.count("*").alias("row_count")).filter("row_count > 1")


def not_null(rows: DataFrame, column: str) -> DataFrame:
    return rows.filter(F.col(column).isNull())


def accepted_values(rows: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Values outside the list, with their row counts."""
    odd = rows.filter(~F.col(column).isin(*values))
    return odd.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("row_count"))


def relationships(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys, with row counts, that the parent lacks; NULLs are allowed."""
    return missing_keys(child, child_key, parent, parent_key)


def history_overlaps(history: DataFrame, key: str = "customer_id", block: Column | None = None) -> DataFrame:
    """Versions that reach past the start of the next one.

    Versions are compared inside calendar months and across months by one
    summary row each, so a key with very many versions is not one task's work.
    """
    starts = history.select(key, "valid_from", "valid_to", "scd_id").withColumn(
        # versions that start together are ordered by their end
        "_order",
        F.struct("valid_from", F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp")).alias("ends"), "scd_id"))
    following = with_previous(
        starts, [key], "_order", "valid_from", F.trunc("valid_from", "month") if block is None else block,
        "next_valid_from", descending=True)
    return following.filter(
        F.col("next_valid_from").isNotNull()
        & (F.col("valid_to").isNull() | (F.col("valid_to") > F.col("next_valid_from")))
    ).select(key, "valid_from", "valid_to", "next_valid_from")


def not_one_open_version(history: DataFrame, key: str = "customer_id") -> DataFrame:
    counted = history.groupBy(key).agg(F.count_if(F.col("valid_to").isNull()).alias("latest_version_count"))
    return counted.filter(F.col("latest_version_count") != 1)


def _beyond(left: Column, right: Column, tolerance: str) -> Column:
    return F.abs(left - right) > F.lit(tolerance).cast("decimal(14,2)")


def item_totals_differ(orders: DataFrame, items: DataFrame, tolerance: str = MONEY_TOLERANCE) -> DataFrame:
    """Orders whose total is not the sum of their lines."""
    totals = items.groupBy("order_key").agg(F.sum("line_total").alias("item_total"))
    joined = orders.select("order_key", "order_id", "order_total").join(totals, "order_key", "left").select(
        "order_id", "order_total", F.coalesce("item_total", F.lit(0)).alias("calculated_order_total"))
    return joined.filter(_beyond(F.col("order_total"), F.col("calculated_order_total"), tolerance))


def payment_totals_differ(orders: DataFrame, payments: DataFrame, tolerance: str = MONEY_TOLERANCE) -> DataFrame:
    """Orders without exactly one payment, or with another amount."""
    totals = payments.groupBy("order_key").agg(
        F.count("*").alias("n"), F.sum("amount").alias("paid"))
    joined = orders.select("order_key", "order_id", "order_total").join(totals, "order_key", "left").select(
        "order_id", "order_total",
        F.coalesce("n", F.lit(0)).alias("payment_count"),
        F.coalesce("paid", F.lit(0)).alias("total_payment_amount"))
    return joined.filter(
        (F.col("payment_count") != 1)
        | _beyond(F.col("order_total"), F.col("total_payment_amount"), tolerance))


def daily_totals(orders: DataFrame, payments: DataFrame, shipments: DataFrame, mart: DataFrame) -> DataFrame:
    """One row: counts and values of the facts beside those of the daily mart."""
    return one_row(
        orders.agg(F.count("*").alias("fact_order_count"), F.sum("order_total").alias("fact_order_value")),
        payments.agg(F.count("*").alias("fact_payment_count"), F.sum("amount").alias("fact_payment_value")),
        shipments.agg(F.count("*").alias("fact_shipment_count")),
        mart.agg(
            F.sum("order_count").alias("mart_order_count"),
            F.sum("payment_count").alias("mart_payment_count"),
            F.sum("shipment_count").alias("mart_shipment_count"),
            F.sum("gross_order_value").alias("mart_order_value"),
            F.sum("total_payment_value").alias("mart_payment_value"),
        ),
    )


def daily_mart_differs(
    orders: DataFrame, payments: DataFrame, shipments: DataFrame, mart: DataFrame, tolerance: str = MONEY_TOLERANCE
) -> DataFrame:
    """The totals row where facts and mart disagree, else nothing."""
    totals = daily_totals(orders, payments, shipments, mart)
    counts = reduce(lambda a, b: a | b, [
        F.col(f"fact_{n}_count") != F.col(f"mart_{n}_count") for n in ("order", "payment", "shipment")])
    values = reduce(lambda a, b: a | b, [
        _beyond(F.col(f"fact_{n}_value"), F.col(f"mart_{n}_value"), tolerance) for n in ("order", "payment")])
    return totals.filter(counts | values)


def row_rules() -> dict[str, dict[str, Column]]:
    """Row rules of every table: rule name to the condition a row must meet.
    As with a CHECK constraint, NULL passes."""
    def listed(table: str, column: str) -> Column:
        return F.col(column).isin(*SOURCE_VALUES[(table, column)])

    run_window = (
        (F.col("run_mode") == "incremental") & F.col("backfill_start_date").isNull()
        & F.col("backfill_end_date").isNull()
    ) | (
        (F.col("run_mode") == "backfill") & F.col("backfill_start_date").isNotNull()
        & F.col("backfill_end_date").isNotNull()
        & (F.col("backfill_start_date") <= F.col("backfill_end_date"))
    )
    completion = ((F.col("status") == "running") & F.col("completed_at").isNull()) | (
        F.col("status").isin("success", "failed") & F.col("completed_at").isNotNull())
    return {
        "customers": {"status": listed("customers", "customer_status")},
        "products": {"price": F.col("unit_price") > 0},
        "orders": {
            "status": listed("orders", "order_status"),
            "total": F.col("order_total") >= 0,
            "currency": F.col("currency") == "USD",
        },
        "order_items": {"quantity": F.col("quantity") > 0, "price": F.col("unit_price") > 0},
        "payments": {
            "status": listed("payments", "payment_status"),
            "method": listed("payments", "payment_method"),
            "amount": F.col("amount") >= 0,
        },
        "shipments": {
            "status": listed("shipments", "shipment_status"),
            "dates": F.col("delivered_at").isNull() | F.col("shipped_at").isNull()
            | (F.col("delivered_at") >= F.col("shipped_at")),
        },
        "bronze_events": {"operation": F.col("operation").isin("r", "c", "u", "d")},
        "warehouse_load_runs": {"status": F.col("status").isin("running", "succeeded", "failed")},
        "pipeline_runs": {
            "mode": F.col("run_mode").isin("incremental", "backfill"),
            "status": F.col("status").isin("running", "success", "failed"),
            "window": run_window,
            "completion": completion,
        },
    }


def broken_rows(rows: DataFrame, key: str, rules: Mapping[str, Column]) -> DataFrame:
    """``(row_key, rule)`` for every rule a row breaks, all rules in one pass."""
    broken = F.array_compact(F.array(*[
        F.when(~F.coalesce(condition, F.lit(True)), F.lit(name)) for name, condition in rules.items()]))
    return rows.select(F.col(key).cast("string").alias("row_key"), F.explode(broken).alias("rule"))


def source_integrity(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source check with its number of failing rows: five orphan
    checks and the two total checks."""
    def orphans(name: str, child: str, key: str, parent: str) -> DataFrame:
        lost = missing_keys(tables[child], key, tables[parent], key)
        unset = tables[child].filter(F.col(key).isNull()).agg(F.count("*").alias("n"))
        return lost.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("n")).unionByName(unset).agg(
            F.sum("n").alias("failures")).select(F.lit(name).alias("check_name"), "failures")

    def mismatches(name: str, parts: str, value: str) -> DataFrame:
        sums = tables[parts].groupBy("order_id").agg(F.sum(value).alias("part_total"))
        joined = tables["orders"].select("order_id", "order_total").join(sums, "order_id", "left")
        return joined.agg(
            F.count_if(F.col("part_total").isNull() | (F.col("order_total") != F.col("part_total"))).alias("failures")
        ).select(F.lit(name).alias("check_name"), "failures")

    return reduce(DataFrame.unionByName, [
        orphans("orders_without_customer", "orders", "customer_id", "customers"),
        orphans("items_without_order", "order_items", "order_id", "orders"),
        orphans("items_without_product", "order_items", "product_id", "products"),
        orphans("payments_without_order", "payments", "order_id", "orders"),
        orphans("shipments_without_order", "shipments", "order_id", "orders"),
        mismatches("order_total_mismatches", "order_items", "line_total"),
        mismatches("payment_total_mismatches", "payments", "amount"),
    ])


def dataset_problems(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(problem, row_key, row_count)``: duplicate ids, unknown references,
    repeated products in an order, totals and payments that do not match."""
    def tagged(problem: str, rows: DataFrame, key: str, count: str | None = None) -> DataFrame:
        return rows.select(
            F.lit(problem).alias("problem"), F.col(key).cast("string").alias("row_key"),
            (F.col(count) if count else F.lit(1)).cast("long").alias("row_count"))

    def placed(table: str, key: str) -> DataFrame:
        return by_order[table] if key == "order_id" else tables[table]

    def doubled(problem: str, table: str, column: str) -> DataFrame:
        return tagged(problem, unique(placed(table, column), column), column, "row_count")

    def unknown(problem: str, child: str, key: str, parent: str) -> DataFrame:
        return tagged(problem, missing_keys(placed(child, key), key, placed(parent, key), key), "missing_key", "row_count")

    items = tables["order_items"]
    # nearly every row is a group of its own by these keys: adding up ahead of a shuffle, and partitions put together after it, would
    # hold as many groups as a task has rows
    by_order = {name: dealt(tables[name], "order_id") for name in ("orders", "order_items", "payments", "shipments")}
    pairs = unique(dealt(items, "order_id", "product_id"), "order_id", "product_id").withColumn("pair", F.concat_ws("/", "order_id", "product_id"))
    sums = by_order["order_items"].groupBy("order_id").agg(
        F.sum((F.col("unit_price") * F.col("quantity")).cast("decimal(18,2)")).alias("line_sum"))
    off = by_order["orders"].join(sums, "order_id", "left").filter(
        F.col("order_total") != F.coalesce("line_sum", F.lit(0)))
    # orders are unique by id, so only payments can repeat here
    unpaid = by_order["payments"].select("payment_id", "order_id", "amount").join(
        by_order["orders"].select("order_id", "order_total"), "order_id").filter(F.col("amount") != F.col("order_total"))
    return reduce(DataFrame.unionByName, [
        doubled("duplicate customer id", "customers", "customer_id"),
        doubled("duplicate product id", "products", "product_id"),
        doubled("duplicate order id", "orders", "order_id"),
        unknown("order of unknown customer", "orders", "customer_id", "customers"),
        unknown("item of unknown order", "order_items", "order_id", "orders"),
        unknown("item of unknown product", "order_items", "product_id", "products"),
        tagged("order repeats product", pairs, "pair", "row_count"),
        tagged("order total differs from items", off, "order_id"),
        unknown("payment of unknown order", "payments", "order_id", "orders"),
        doubled("order with several payments", "payments", "order_id"),
        tagged("payment differs from order total", unpaid, "payment_id"),
        unknown("shipment of unknown order", "shipments", "order_id", "orders"),
    ])


@dataclass(frozen=True)
class DataTest:
    """A generic test on a column, or a singular one given by its failing rows."""

    kind: str
    table: str
    column: str | None
    rows: DataFrame
    values: tuple[str, ...] = ()
    parent: DataFrame | None = None

    @property
    def name(self) -> str:
        return self.table if self.kind == "singular" else f"{self.kind}:{self.table}.{self.column}"

    def failing(self) -> DataFrame:
        if self.kind == "unique":
            return unique(self.rows, self.column)
        if self.kind == "not_null":
            return not_null(self.rows, self.column)
        if self.kind == "accepted_values":
            return accepted_values(self.rows, self.column, self.values)
        if self.kind == "relationships":
            return relationships(self.rows, self.column, self.parent, self.column)
        return self.rows

    def row_condition(self) -> Column | None:
        """What a failing row looks like, where one row alone can tell."""
        if self.kind == "not_null":
            return F.col(self.column).isNull()
        if self.kind == "accepted_values":
            return ~F.col(self.column).isin(*self.values)
        return None


def run_checks(tests: Sequence[DataTest]) -> DataFrame:
    """One row per test: its name, its failures and whether it passed.

    Tests that look at single rows share one pass over their table. For them
    failures are rows, for the others they are rows of the failing frame.
    """
    per_table: dict[str, list[DataTest]] = {}
    parts: list[DataFrame] = []
    for test in tests:
        if test.row_condition() is not None:
            per_table.setdefault(test.table, []).append(test)
        else:
            parts.append(test.failing().agg(F.count("*").alias("failures")).select(
                F.lit(test.name).alias("check_name"), "failures"))
    for group in per_table.values():
        counted = group[0].rows.agg(*[F.count_if(t.row_condition()).alias(t.name) for t in group])
        parts.append(counted.unpivot([], [F.col(f"`{t.name}`") for t in group], "check_name", "failures"))
    return reduce(DataFrame.union, parts).withColumn("passed", F.col("failures") == 0)
