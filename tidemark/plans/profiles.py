"""Profiles of every layer and the reliability roll-up."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import any_null
from tidemark.operators import aggregates as agg
from tidemark.operators.audit import audit_summary, latest_run, recovered_failures
from tidemark.operators.dedup import duplicate_count
from tidemark.operators.policy import freshness
from tidemark.schemas import FRESHNESS_SLO_SECONDS, MAX_BACKFILL_DAYS, REQUIRED_METADATA, TABLES


def as_metrics(row: DataFrame) -> DataFrame:
    """A one-row frame as ``(metric, value)`` rows, values as text."""
    texts = row.select(*[F.col(c).cast("string").alias(c) for c in row.columns])
    return texts.unpivot([], texts.columns, "metric", "value")


def metadata_summary(bronze: DataFrame) -> DataFrame:
    """Event counts per table, operation, topic partition and day: all the low
    cardinality facts of a layer from one pass."""
    nulls = reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in REQUIRED_METADATA])
    return bronze.groupBy("source_table", "operation", "kafka_topic", "kafka_partition", "event_date").agg(
        F.count("*").alias("n"), F.sum(nulls).alias("null_metadata"))


def bronze_profile(bronze: DataFrame, quarantine: DataFrame, minimum_events: int = 0,
                   tables: Sequence[str] = TABLES) -> DataFrame:
    """One row on bronze and quarantine: volumes, duplicates, coverage, missing
    metadata, latency percentiles and a verdict."""
    expected = F.array(*[F.lit(t) for t in sorted(tables)])
    summary = metadata_summary(bronze)
    coverage = summary.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("bronze_records"),
        F.countDistinct("kafka_topic").alias("topic_count"),
        F.countDistinct("kafka_topic", "kafka_partition").alias("topic_partition_count"),
        F.countDistinct("event_date").alias("event_date_count"),
        F.countDistinct("source_table", "event_date").alias("table_date_partition_count"),
        F.coalesce(F.sum("null_metadata"), F.lit(0)).alias("total_null_metadata"),
        F.sort_array(F.collect_set("source_table")).alias("seen"),
    ).select(
        "*",
        F.size("seen").cast("long").alias("source_table_count"),
        F.concat_ws(",", F.array_except(expected, "seen")).alias("missing_tables"),
        F.concat_ws(",", F.array_except("seen", expected)).alias("unexpected_tables"),
    ).drop("seen")
    ids = duplicate_count(bronze).select(
        F.col("distinct_count").alias("unique_event_ids"), F.col("duplicate_count").alias("duplicate_event_ids"))
    bad = duplicate_count(quarantine).select(
        F.col("row_count").alias("quarantine_records"),
        F.col("distinct_count").alias("quarantine_unique_event_ids"),
        F.col("duplicate_count").alias("quarantine_duplicate_event_ids"))
    row = agg.one_row(coverage, ids, bad, agg.approximate_percentiles(agg.connector_latency(bronze)))
    return row.withColumn(
        "valid",
        (F.col("bronze_records") >= minimum_events)
        & (F.col("missing_tables") == "") & (F.col("unexpected_tables") == "")
        & (F.col("duplicate_event_ids") == 0) & (F.col("total_null_metadata") == 0)
        & (F.col("quarantine_duplicate_event_ids") == 0),
    )


def source_profile(tables: Mapping[str, DataFrame], integrity: DataFrame) -> DataFrame:
    """``(metric, value)`` of the source tables: sizes, status counts, failing
    integrity checks, order value."""
    def counted(table: str, column: str) -> DataFrame:
        return tables[table].groupBy(column).agg(F.count("*").alias("n")).select(
            F.concat(F.lit(f"{table}."), F.coalesce(column, F.lit("null"))).alias("metric"),
            F.col("n").cast("string").alias("value"))

    sizes = agg.table_counts(tables).select(
        F.concat(F.lit("rows."), "table_name").alias("metric"), F.col("row_count").cast("string").alias("value"))
    failures = integrity.select(
        F.concat(F.lit("failures."), "check_name").alias("metric"), F.col("failures").cast("string").alias("value"))
    money = as_metrics(tables["orders"].agg(
        F.coalesce(F.sum("order_total"), F.lit(0)).cast("decimal(24,2)").alias("total_order_value"),
        F.coalesce(F.round(F.sum("order_total") / F.count("order_total"), 2), F.lit(0)).cast("decimal(24,2)").alias(
            "average_order_value")))
    return reduce(DataFrame.unionByName, [
        sizes, failures, money, counted("orders", "order_status"), counted("payments", "payment_status"),
        counted("shipments", "shipment_status")])


RAW_REQUIRED = ("event_id", "source_table", "operation", "kafka_topic", "kafka_partition", "kafka_offset")


def raw_quality(raw: DataFrame, required: Sequence[str] = RAW_REQUIRED) -> DataFrame:
    """One row: raw events, distinct ids, duplicates, rows with missing metadata."""
    per_id = raw.groupBy("event_id").agg(F.count("*").alias("n"), F.count_if(any_null(required)).alias("bad"))
    return per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("raw_bronze_records"),
        F.count("event_id").alias("unique_raw_event_ids"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("event_id")).alias("duplicate_raw_event_ids"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("null_required_metadata"),
    )


def history_summary(history: DataFrame, key: str = "customer_id") -> DataFrame:
    per_key = history.groupBy(key).agg(
        F.count("*").alias("n"), F.count_if(F.col("valid_to").isNull()).alias("open"),
        F.count_if("is_deleted").alias("deleted"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("snapshot_versions"),
        F.count(key).alias("snapshot_customers"),
        F.coalesce(F.sum("open"), F.lit(0)).alias("current_snapshot_versions"),
        F.coalesce(F.sum(F.col("n") - F.col("open")), F.lit(0)).alias("historical_snapshot_versions"),
        F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted_snapshot_versions"),
    )


def money_reconciliation(orders: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    totals = agg.one_row(
        orders.agg(F.sum("order_total").cast("decimal(24,2)").alias("total_order_value")),
        items.agg(F.sum("line_total").cast("decimal(24,2)").alias("total_line_value")),
        payments.agg(F.sum("amount").cast("decimal(24,2)").alias("total_payment_value")))
    return totals.withColumns({
        "order_item_difference": F.abs(F.col("total_order_value") - F.col("total_line_value")).cast("decimal(24,2)"),
        "order_payment_difference": F.abs(
            F.col("total_order_value") - F.col("total_payment_value")).cast("decimal(24,2)"),
    })


def daily_summary(mart: DataFrame) -> DataFrame:
    return mart.agg(
        F.count("*").alias("reporting_days"),
        (F.count("*") - F.countDistinct("order_date")).alias("duplicate_reporting_days"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.sum("order_count").alias("daily_order_count"),
        F.sum("payment_count").alias("daily_payment_count"),
        F.sum("shipment_count").alias("daily_shipment_count"),
        F.sum("gross_order_value").cast("decimal(24,2)").alias("daily_order_value"),
        F.sum("total_payment_value").cast("decimal(24,2)").alias("daily_payment_value"),
    )


def warehouse_profile(star: Mapping[str, DataFrame], raw: DataFrame | None = None,
                      current: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """``(metric, value)`` of the warehouse. ``star`` holds the history, the
    dimensions, facts and marts by name."""
    rows = [
        history_summary(star["snap_customers"]),
        money_reconciliation(star["fact_orders"], star["fact_order_items"], star["fact_payments"]),
        daily_summary(star["mart_daily_commerce"]),
    ]
    if raw is not None:
        rows.append(raw_quality(raw))
    wide = as_metrics(agg.one_row(*rows))
    counted = {n: f for n, f in star.items() if n != "snap_customers"}
    if current is not None:
        counted |= {f"current.{n}": f for n, f in current.items()}
    sizes = agg.table_counts(counted).select(
        F.concat(F.lit("rows."), "table_name").alias("metric"), F.col("row_count").cast("string").alias("value"))
    return wide.unionByName(sizes)


def audit_profile(runs: DataFrame, mart: DataFrame | None = None, max_days: int = MAX_BACKFILL_DAYS) -> DataFrame:
    """One row: run counts, incomplete records, newest runs, recovered failures
    and, with the daily mart, its totals."""
    status, mode = F.col("status"), F.col("run_mode")
    rows = [
        audit_summary(runs),
        latest_run(runs, (mode == "incremental") & (status == "success")).select(
            F.col("run_id").alias("latest_incremental_run"), F.col("duration_seconds").alias("latest_incremental_seconds")),
        latest_run(runs, (mode == "backfill") & (status == "success")).select(
            F.col("run_id").alias("latest_backfill_run"),
            (F.datediff("backfill_end_date", "backfill_start_date") + 1).cast("long").alias("backfill_window_days")),
        latest_run(runs, status == "failed").select(
            F.col("run_id").alias("latest_failed_run"), F.col("failed_task_id").alias("latest_failed_task")),
        recovered_failures(runs).agg(F.count("*").alias("recovered_backfill_failures")),
    ]
    if mart is not None:
        rows.append(daily_summary(mart))
    return agg.one_row(*rows).withColumn(
        "window_is_valid", F.col("backfill_window_days").between(1, max_days))


def check_rows(row: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """A one-row frame turned into ``(check_name, passed)`` rows; a check that
    cannot be decided has failed."""
    judged = row.select(*[F.coalesce(c, F.lit(False)).alias(n) for n, c in checks.items()])
    return judged.unpivot([], list(checks), "check_name", "passed")


def audit_checks(
    profile: DataFrame, expected_days: Column, expected_orders: Column, expected_value: Column
) -> DataFrame:
    """The checks on the run audit and the daily mart; the expected sizes are
    literals or scalar subqueries."""
    # fixed values: the names of the checks
    return check_rows(profile, {
        "successful_incremental_exists": F.col("successful_incremental_runs") >= 1,
        "successful_backfill_exists": F.col("successful_backfill_runs") >= 1,
        "no_running_audit_records": F.col("running_runs") == 0,
        "completed_audit_records_are_consistent": F.col("inconsistent_completed_runs") == 0,
        "failure_records_identify_tasks": F.col("incomplete_failure_records") == 0,
        "backfill_window_is_valid": F.col("window_is_valid"),
        "reporting_dates_are_unique": F.col("duplicate_reporting_days") == 0,
        "reporting_day_count_reconciles": F.col("reporting_days") == expected_days,
        "order_count_reconciles": F.col("daily_order_count") == expected_orders,
        "order_value_reconciles": F.col("daily_order_value") == expected_value,
    })


def reliability_checks(
    bronze_row: DataFrame, raw: DataFrame, tables: DataFrame, events: DataFrame, runs: DataFrame,
    latency: DataFrame, topics: DataFrame, checked_at: Column, slo_seconds: int = FRESHNESS_SLO_SECONDS,
    services: Mapping[str, bool] | None = None,
) -> DataFrame:
    """The service-level roll-up as ``(check_name, passed)``.

    ``bronze_row`` is the bronze profile, ``tables`` and ``events`` are
    reconciliations, ``topics`` a topic summary. ``services`` adds the states of
    outside services where the caller knows them.
    """
    required = (*RAW_REQUIRED, "ingested_at", "warehouse_loaded_at")
    facts = agg.one_row(
        bronze_row.select(F.col("valid").alias("bronze_valid")),
        raw_quality(raw, required),
        raw.agg(F.max("warehouse_loaded_at").alias("loaded_at")),
        tables.agg(F.bool_and("reconciled").alias("tables_reconcile")),
        events.agg(F.bool_and("reconciled").alias("events_reconcile")),
        runs.agg(
            F.count_if(F.col("status") == "success").alias("successes"),
            F.max(F.when(F.col("status") == "success", F.col("completed_at"))).alias("succeeded_at")),
        latency.select("measured_events"),
        topics.agg(F.coalesce(F.bool_or(F.col("expected") & F.col("missing")), F.lit(False)).alias("topics_missing")),
    )
    # fixed values: the names of the checks
    checks = {
        "live_bronze_profile_is_valid": F.col("bronze_valid"),
        "source_to_bronze_current_state_reconciles": F.col("tables_reconcile"),
        "bronze_to_warehouse_events_reconcile": F.col("events_reconcile"),
        "warehouse_event_ids_are_unique": F.col("duplicate_raw_event_ids") == 0,
        "required_metadata_is_complete": F.col("null_required_metadata") == 0,
        "kafka_topics_are_healthy": ~F.col("topics_missing"),
        "successful_pipeline_run_exists": F.col("successes") >= 1,
        "warehouse_data_meets_freshness_slo": freshness(F.col("loaded_at"), checked_at) <= slo_seconds,
        "pipeline_meets_freshness_slo": freshness(F.col("succeeded_at"), checked_at) <= slo_seconds,
        "latency_measurements_exist": F.col("measured_events") > 0,
    }
    checks |= {name: F.lit(bool(state)) for name, state in (services or {}).items()}
    return check_rows(facts, checks)


def check_summary(checks: DataFrame) -> DataFrame:
    """One row: passed, total, and whether there are checks and all passed."""
    return checks.agg(
        F.count_if("passed").alias("passed"),
        F.count("*").alias("total"),
        ((F.count("*") > 0) & (F.count_if("passed") == F.count("*"))).alias("all_passed"),
    )


def dashboard_cards(
    checks: DataFrame, deployment: DataFrame, events: DataFrame, raw_row: DataFrame, bronze_row: DataFrame,
    age: DataFrame, slo_seconds: int = FRESHNESS_SLO_SECONDS,
) -> DataFrame:
    """The eight cards as ``(position, label, value, healthy, detail)``, and the
    inputs of the overall verdict: it is healthy when both check groups pass."""
    facts = agg.one_row(
        check_summary(checks).select(*[F.col(c).alias(f"c_{c}") for c in ("passed", "total", "all_passed")]),
        check_summary(deployment).select(*[F.col(c).alias(f"d_{c}") for c in ("passed", "total", "all_passed")]),
        events.agg(
            F.sum("source_count").alias("bronze"), F.sum("target_count").alias("warehouse"),
            F.sum("difference").alias("difference")),
        raw_row.select("duplicate_raw_event_ids"),
        bronze_row.select("quarantine_records", "valid"),
        age.select("age_seconds"),
    )

    def whole(column: str) -> Column:
        return F.format_number(F.coalesce(F.col(column), F.lit(0)).cast("long"), 0)

    def seconds(value: Column) -> Column:
        return F.concat(F.format_number(value.cast("double"), 3), F.lit(" seconds"))

    age_s = F.coalesce(F.col("age_seconds"), F.lit(0))
    cards = [
        ("Checks on data", F.concat_ws("/", "c_passed", "c_total"), F.col("c_all_passed"),
         F.lit("Passed of all checks on data and runs")),
        ("Checks on services", F.concat_ws("/", "d_passed", "d_total"), F.col("d_all_passed"),
         F.lit("Passed of all reported services")),
        ("Events in the lake", whole("bronze"), F.col("bronze") > 0, F.lit("Valid events the stream has written")),
        ("Events loaded", whole("warehouse"),
         (F.col("warehouse") > 0) & (F.col("warehouse") == F.col("bronze")), F.lit("Rows of the raw table")),
        ("Loaded minus streamed", whole("difference"), F.col("difference") == 0, F.lit("Zero when every event arrived")),
        ("Repeated ids", whole("duplicate_raw_event_ids"), F.col("duplicate_raw_event_ids") == 0,
         F.lit("Rows of the raw table beyond one for each id")),
        ("Age of the newest row", seconds(age_s), (F.lit(slo_seconds) > 0) & (age_s <= slo_seconds),
         F.concat(F.lit("At most "), seconds(F.lit(slo_seconds)))),
        ("Events set apart", whole("quarantine_records"), F.col("valid"),
         F.lit("Each with the reason it was not valid")),
    ]
    packed = F.array(*[
        F.struct(
            F.lit(n).alias("position"), F.lit(label).alias("label"), value.alias("value"),
            F.coalesce(healthy, F.lit(False)).alias("healthy"), detail.alias("detail"))
        for n, (label, value, healthy, detail) in enumerate(cards, start=1)
    ])
    return facts.select(F.explode(packed).alias("card")).select("card.*")


def failed_checks(groups: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        checks.filter(~F.col("passed")).select(F.lit(group).alias("check_group"), "check_name")
        for group, checks in groups.items()
    ])


def overall_status(groups: Mapping[str, DataFrame]) -> DataFrame:
    """``healthy`` when every group has checks and all of them pass."""
    summaries = reduce(DataFrame.unionByName, [check_summary(c) for c in groups.values()])
    return summaries.agg(
        F.when(F.bool_and("all_passed"), "healthy").otherwise("attention_required").alias("status"))


def latency_rows(latency: DataFrame) -> DataFrame:
    """Stage latencies as text rows, for display."""
    def text(column: str) -> Column:
        return F.concat(F.format_number(F.coalesce(F.col(column), F.lit(0)).cast("double"), 3), F.lit(" ms"))

    stages = (("Debezium connector", "connector"), ("Bronze processing", "bronze_processing"),
              ("Warehouse load", "warehouse_load"), ("End to end", "end_to_end"))
    packed = F.array(*[
        F.struct(F.lit(label).alias("stage"), text(f"{name}_average").alias("average"),
                 text(f"{name}_maximum").alias("maximum"))
        for label, name in stages
    ])
    return latency.select(F.explode(packed).alias("s")).select("s.*")
