"""Every operator as a query over the given tables.

Results are put in plain types at the end (:func:`plain`), so that they can be
compared with another engine's: money and other decimals as doubles, dates and
timestamps as text, arrays joined.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.envelope import parse_envelope
from tidemark.functions.keys import event_id, position_problem
from tidemark.operators import aggregates as agg
from tidemark.operators import audit, checks, dedup, event_history, events, policy, staging, star, strict
from tidemark.operators.current import current_from_raw, current_keys, current_state, live_rows
from tidemark.plans import marts, profiles, refresh
from tidemark.plans.build import HISTORY_SCHEMA, build_star
from tidemark.plans.load import load_bronze
from tidemark.schemas import ACCEPTED_VALUES, ENTITIES, REQUIRED_METADATA, SOURCE_VALUES, TABLES
from tidemark.session import scratch_path, use_utc
from tidemark.sources import records, tables
from tidemark.sources.lake import HistoryTable, Lake, drop_part, drop_stored, replace_rows, stored
from tidemark.sources.versions import StateTable, VersionedTable
from tidemark.streaming.bronze import BronzePaths, read_bronze, read_quarantine, run_bronze_stream, stream_report
from tidemark.streaming.lateness import start_order_stream

Query = Callable[[SparkSession, str], DataFrame]

RUN_ID = "catalog"
# Snapshot times of the history: after the reads, updates, deletes, re-creations.
SNAPSHOTS = ("1995-06-01", "1997-01-01", "1998-06-01", "2000-09-01")
FIRST_LOAD_UNTIL = date(2024, 1, 16)
LOOKED_UP = "run-7"
BACKFILL = (date(1996, 1, 5), date(1996, 1, 20))
CHECKED_AT = datetime(2024, 3, 2, tzinfo=timezone.utc)


def plain(frame: DataFrame) -> DataFrame:
    def shape(name: str, kind: str):
        column = F.col(f"`{name}`")
        if kind.startswith("decimal"):
            column = column.cast("double")
        elif kind == "timestamp":
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")
        elif kind == "date":
            column = column.cast("string")
        elif kind.startswith("array"):
            column = F.concat_ws(",", column)
        elif kind in ("tinyint", "smallint", "int"):
            column = column.cast("long")
        return column.alias(name)

    return frame.select(*[shape(name, kind) for name, kind in frame.dtypes])


# ---- inputs -----------------------------------------------------------------

def _bronze(spark: SparkSession, sf: str, replays: bool = False) -> DataFrame:
    return events.bronze_events(tables.stream_records(spark, sf, replays), RUN_ID)


def _valid(spark: SparkSession, sf: str, replays: bool = False) -> DataFrame:
    return events.valid_events(_bronze(spark, sf, replays))


def _raw_log(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """The change log of an entity as it lies in the raw table."""
    log = events.valid_events(events.bronze_events(tables.change_records(spark, sf, name), RUN_ID))
    return dedup.stamped(log, F.lit(tables.LOADED_AT).cast("timestamp"))


def _current(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return current_from_raw(_raw_log(spark, sf, name), name)


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """Four merges of the customer change log into a fresh history table, each
    of the state after one more day of the log."""
    typed = staging.typed_events(staging.normalised_events(_raw_log(spark, sf, "customers")), "customers")
    log = stored(typed, "customer_log")
    table = HistoryTable(spark, scratch_path(spark, "history"), HISTORY_SCHEMA, "customer_id")
    for days, moment in enumerate(SNAPSHOTS, start=1):
        seen = log.filter(F.col("source_timestamp_ms") < tables.LOG_EPOCH_MS + days * tables.DAY_MS)
        table.merge(current_state(seen, "customers"), F.lit(moment).cast("timestamp"))
    return table.read()


def _states(spark: SparkSession, sf: str, deal: bool = True) -> dict[str, DataFrame]:
    return {name: tables.current(spark, sf, name, deal) for name in TABLES}


def _first_versions(spark: SparkSession, sf: str, deal: bool = True) -> DataFrame:
    """Customer versions as they are after the first snapshot."""
    return tables.current(spark, sf, "customers", deal).withColumns({
        "valid_from": F.col("updated_at"), "valid_to": F.lit(None).cast("timestamp"), "is_deleted": F.lit(False)})


def _facts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return build_star(_states(spark, sf), _first_versions(spark, sf))


def _order_facts(spark: SparkSession, sf: str, orders: DataFrame | None = None) -> DataFrame:
    """The order fact without its customer lookup, which daily totals and
    reconciliations do not need."""
    return star.order_facts(tables.current(spark, sf, "orders") if orders is None else orders)


def _daily_facts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return _facts(spark, sf) | {"fact_orders": _order_facts(spark, sf)}


def _timed(spark: SparkSession, sf: str) -> DataFrame:
    """Valid events with fixed ingestion and load times."""
    n = F.col("kafka_offset")
    later = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n % 7).cast("int"))
    last = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (n % 5 * 2).cast("int"))
    ingested = F.col("kafka_timestamp") + later
    return _valid(spark, sf).withColumns({"ingested_at": ingested, "warehouse_loaded_at": ingested + last})


# ---- events -----------------------------------------------------------------

def event_ids(spark, sf):
    return _bronze(spark, sf).select(
        "kafka_topic", "kafka_partition", "kafka_offset", "event_id", "source_table",
        F.unix_millis("event_timestamp").alias("event_ms"), "event_date")


def event_validity(spark, sf):
    return _bronze(spark, sf).select(
        "event_id", "source_table", "operation", "source_timestamp_ms", "connector_timestamp_ms", "source_lsn",
        "source_transaction_id", "key_json", "before_json", "after_json", "payload_json", "schema_name",
        "invalid_reason")


def quarantine_counts(spark, sf):
    return agg.count_by(events.quarantined_events(_bronze(spark, sf)), "invalid_reason")


def strict_validity(spark, sf):
    """Both validity policies side by side on structurally faulty envelopes."""
    judged = strict.strict_validity(events.bronze_events(tables.faulty_envelopes(spark, sf), RUN_ID))
    return judged.select(
        "kafka_offset", "valid", "strict_reason", "strict_operation", "strict_table",
        F.col("invalid_reason").alias("lenient_reason"))


def record_keys(spark, sf):
    """Key of the changed row, unwrapped from either image."""
    parsed = tables.change_records(spark, sf, "customers").select(
        "offset", parse_envelope(F.col("value").cast("string")).alias("envelope"))
    return parsed.select("offset", events.record_key("envelope", "customer_id").alias("record_key"))


def _typed(name: str) -> Query:
    def query(spark, sf):
        typed = staging.typed_events(staging.normalised_events(_raw_log(spark, sf, name)), name)
        return typed.select(
            "event_id", "operation", "is_deleted", *ENTITIES[name].columns, "cast_failed", "source_timestamp_ms",
            "kafka_partition", "kafka_offset")
    return query


def topic_summary(spark, sf):
    return records.topic_summary(tables.stream_records(spark, sf), records.topics(tables.TOPIC_PREFIX))


# ---- dedup and load ---------------------------------------------------------

def dedup_events(spark, sf):
    return dedup.dedup_events(_valid(spark, sf, replays=True)).select(
        "event_id", "kafka_topic", "kafka_partition", "kafka_offset", "operation")


def duplicate_summary(spark, sf):
    return dedup.duplicate_count(_valid(spark, sf, replays=True))


def _first_load(spark, sf):
    return _valid(spark, sf).filter(F.col("event_date") < F.lit(FIRST_LOAD_UNTIL))


def incremental_new_events(spark, sf):
    fresh = dedup.new_events(_valid(spark, sf, replays=True), _first_load(spark, sf))
    return dedup.dedup_events(fresh).select("event_id", "source_table", "event_date", "kafka_offset")


def load_verification(spark, sf):
    return dedup.load_verification(_valid(spark, sf, replays=True), _first_load(spark, sf))


def _current_query(name: str) -> Query:
    return lambda spark, sf: _current(spark, sf, name)


def _incremental_query(name: str) -> Query:
    """The state kept up over four loads, of which the deletes come before the updates they follow: late events lose."""
    def query(spark, sf):
        typed = staging.typed_events(staging.normalised_events(_raw_log(spark, sf, name)), name)
        # what the state of a key is made of, and what its events are ordered by; ids follow from positions
        day = F.floor((F.col("source_timestamp_ms") - tables.LOG_EPOCH_MS) / tables.DAY_MS)
        typed = typed.select("operation", "is_deleted", *ENTITIES[name].columns, "event_timestamp", "source_timestamp_ms",
                             "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp", "warehouse_loaded_at", day.alias("_day"))
        log = stored(typed, f"{name}_log", "zstd", "_day")
        state = StateTable(VersionedTable(spark, scratch_path(spark, f"state_{name}")), ENTITIES[name].key, 8, {
            "event_id": lambda c: event_id(c("kafka_topic"), c("kafka_partition"), c("kafka_offset"))})
        version = None
        for number, loaded in enumerate((0, 2, 1, 3), start=1):
            before, (version, _) = version, state.merge(version, number, log.filter(F.col("_day") == loaded).drop("_day"))
            # a load that is merged and a state that is followed by another are not read again
            drop_part(log, "_day", loaded)
            if before is not None:
                state.table.expire([version], [before])
        drop_stored(log)
        return live_rows(state.read(version), name)

    return query


class _Died(RuntimeError):
    pass


class _Dying(refresh.Build):
    """A build that has written states, history, customers and orders when it dies."""

    def dated(self, entity: str, key: str, fact) -> None:
        raise _Died(entity)


def incremental_build(spark, sf):
    """The daily mart as readers see it while a build on changed data dies (``during``), and after the build that
    follows (``after``)."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    moment = datetime(2024, 3, 2, tzinfo=timezone.utc)
    # records arrive a second after the change; a load makes its own, which costs less than to keep all of them
    day = F.floor((F.unix_millis("timestamp") - 1000 - tables.LOG_EPOCH_MS) / tables.DAY_MS)
    log = reduce(DataFrame.unionByName, [
        tables.change_records(spark, sf, name) for name in ("customers", "orders", "payments", "shipments")])

    def load(records: DataFrame, hours: int) -> None:
        later = F.lit(tables.LOADED_AT).cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(hours))
        raw = dedup.stamped(events.valid_events(events.bronze_events(records, RUN_ID)), later)
        lake.append(raw.select(*refresh.RAW_COLUMNS), "raw", "bronze_events", ("source_table",))

    def seen(when: str) -> DataFrame:
        mart = lake.read("marts", refresh.DAILY).drop("orchestration_run_id", "refreshed_at")
        return stored(mart.select(F.lit(when).alias("seen"), "*"), f"daily_{when}")

    def build(run: str, kind: type[refresh.Build] = refresh.Build) -> None:
        one = kind(lake, run, moment, only=[refresh.DAILY])
        one.run()
        one.publish()

    load(log.filter(day == 0), 0)
    build("first")
    load(log.filter(day > 0), 1)
    with contextlib.suppress(_Died):
        build("dies", _Dying)
    during = seen("during")
    build("last")
    return during.unionByName(seen("after"))


# ---- history, dimensions, facts ---------------------------------------------

def scd2_history(spark, sf):
    return _history(spark, sf)


def dim_customers(spark, sf):
    return star.dim_customers(_history(spark, sf))


def scd_checks(spark, sf):
    history = _history(spark, sf)
    return agg.one_row(
        profiles.history_summary(history),
        checks.history_overlaps(history).agg(F.count("*").alias("overlaps")),
        checks.not_one_open_version(history).agg(F.count("*").alias("keys_without_one_open_version")))


def scd_overlaps(spark, sf):
    """Overlaps in a history whose closed versions of every third key end late."""
    late = F.when(
        (F.col("customer_id") % 3 == 0) & F.col("valid_to").isNotNull(),
        F.col("valid_to") + F.expr("interval 2 days")).otherwise(F.col("valid_to"))
    return checks.history_overlaps(_history(spark, sf).withColumn("valid_to", late))


def scd_open_versions(spark, sf):
    """Keys without exactly one open version, where the open version of every
    fourth key was closed."""
    closed = F.when(F.col("customer_id") % 4 == 0, F.coalesce("valid_to", F.lit("2001-01-01").cast("timestamp"))
                    ).otherwise(F.col("valid_to"))
    return checks.not_one_open_version(_history(spark, sf).withColumn("valid_to", closed))


def dim_products(spark, sf):
    return star.dim_products(tables.current(spark, sf, "products"))


def fact_orders_asof(spark, sf):
    return star.fact_orders(tables.current(spark, sf, "orders"), star.dim_customers(_history(spark, sf)))


def fact_orders_interleaved(spark, sf):
    return star.fact_orders_interleaved(tables.current(spark, sf, "orders"), star.dim_customers(_history(spark, sf)))


def customer_event_history(spark, sf):
    """Every version of every customer, from the change log alone."""
    typed = staging.typed_events(staging.normalised_events(_raw_log(spark, sf, "customers")), "customers")
    return event_history.history_from_events(typed, "customers")


def _fact(name: str) -> Query:
    return lambda spark, sf: _facts(spark, sf)[name]


# ---- marts ------------------------------------------------------------------

def _daily(facts: dict[str, DataFrame], start: date | None = None, end: date | None = None) -> DataFrame:
    return marts.mart_daily(facts["fact_orders"], facts["fact_payments"], facts["fact_shipments"], start, end)


def mart_daily(spark, sf):
    return _daily(_daily_facts(spark, sf))


def mart_daily_scope(spark, sf):
    return _daily(_daily_facts(spark, sf), *BACKFILL)


def mart_daily_backfill(spark, sf):
    """The daily mart of the first read, with the days of a window recomputed
    from the changed orders."""
    facts = _daily_facts(spark, sf)
    before = _daily(facts)
    changed = _order_facts(spark, sf, stored(_current(spark, sf, "orders"), "orders"))
    after = _daily(facts | {"fact_orders": changed}, *BACKFILL)
    return replace_rows(before, stored(after, "days"), "order_date")


def mart_customer_value(spark, sf):
    facts = _facts(spark, sf)
    return marts.mart_customer_value(facts["dim_customers"], facts["fact_orders"])


def mart_customer_value_from_changes(spark, sf):
    """From change records to the mart: state, history, as-of fact, mart."""
    customers = star.dim_customers(_history(spark, sf))
    # no more than the mart reads
    orders = stored(star.order_facts(_current(spark, sf, "orders")).select(*marts.CUSTOMER_VALUE_COLUMNS), "orders")
    return marts.mart_customer_value(customers, star.with_customer_key(orders, customers))


def mart_product_performance(spark, sf):
    items = star.item_facts(tables.current(spark, sf, "order_items"))
    return marts.mart_product_performance(star.dim_products(tables.current(spark, sf, "products")), items)


def mart_daily_from_changes(spark, sf):
    facts = {
        "fact_orders": star.order_facts(_current(spark, sf, "orders")),
        "fact_payments": star.fact_payments(_current(spark, sf, "payments")),
        "fact_shipments": star.fact_shipments(_current(spark, sf, "shipments"))}
    # stored, since their joins would else be planned by sizes guessed from the compressed inputs; no more than the mart reads
    return _daily({name: stored(facts[name].select(*columns), name) for name, columns in marts.DAILY_COLUMNS.items()})


def mart_product_performance_from_changes(spark, sf):
    return marts.mart_product_performance(
        star.dim_products(_current(spark, sf, "products")), star.item_facts(_current(spark, sf, "order_items")))


# ---- data tests -------------------------------------------------------------

def check_unique(spark, sf):
    """Orders that repeat a product."""
    return checks.unique(tables.order_items(spark, sf), "order_id", "product_id")


def check_not_null(spark, sf):
    return checks.not_null(tables.shipments(spark, sf), "shipped_at").select("shipment_id", "shipment_status")


def check_accepted(spark, sf):
    """Payment states outside a list without refunds."""
    allowed = [v for v in ACCEPTED_VALUES[("payments", "payment_status")] if v != "refunded"]
    return checks.accepted_values(tables.payments(spark, sf), "payment_status", allowed)


def check_relationships(spark, sf):
    """Orders of customers deleted since."""
    return checks.relationships(
        tables.orders(spark, sf), "customer_id", _current(spark, sf, "customers"), "customer_id")


def check_item_totals(spark, sf):
    """Lines against orders: the totals of most orders are those of their lines,
    a seventh is off by a cent (tolerated), a thirteenth by a dollar."""
    items = star.item_facts(tables.current(spark, sf, "order_items"))
    return checks.item_totals_differ(_order_facts(spark, sf, _line_totals(spark, sf)), items)


def _line_totals(spark, sf) -> DataFrame:
    """Orders with the totals of their lines, some made wrong."""
    totals = tables.order_items(spark, sf).groupBy("order_id").agg(F.sum("line_total").alias("total"))
    key = F.col("order_id")
    off = F.when(key % 13 == 0, F.lit("1.00")).when(key % 7 == 0, F.lit("0.01")).otherwise(F.lit("0.00"))
    orders = tables.current(spark, sf, "orders").join(totals, "order_id", "left")
    total = F.coalesce(F.col("total"), F.lit(0)) + off.cast("decimal(14,2)")
    return orders.withColumn("order_total", total.cast("decimal(14,2)")).drop("total")


def check_payment_totals(spark, sf):
    """Payments against orders; transfers are a dollar short, cards a cent."""
    facts = _facts(spark, sf)
    short = F.when(F.col("payment_method") == "bank_transfer", F.lit("1.00")).when(
        F.col("payment_method") == "credit_card", F.lit("0.01")).otherwise(F.lit("0.00"))
    changed = facts["fact_payments"].withColumn(
        "amount", (F.col("amount") - short.cast("decimal(14,2)")).cast("decimal(14,2)"))
    return checks.payment_totals_differ(_order_facts(spark, sf), changed)


def check_daily_reconcile(spark, sf):
    """Facts against a daily mart that counts one order too many on each day of
    the backfill window."""
    facts = _facts(spark, sf) | {"fact_orders": _order_facts(spark, sf)}
    inside = F.col("order_date").between(*[F.lit(d) for d in BACKFILL])
    mart = _daily(facts).withColumn("order_count", F.col("order_count") + F.when(inside, 1).otherwise(0))
    return checks.daily_mart_differs(
        facts["fact_orders"], facts["fact_payments"], facts["fact_shipments"], mart)


def check_rows(spark, sf):
    """Row rules on every entity, with prices and dates shifted so that some
    rows break them."""
    rules = checks.row_rules()
    broken = tables.entities(spark, sf)
    broken["products"] = broken["products"].withColumn("unit_price", F.col("unit_price") - 950)
    broken["orders"] = broken["orders"].withColumn(
        "currency", F.when(F.col("order_id") % 31 == 0, "EUR").otherwise(F.col("currency")))
    broken["order_items"] = broken["order_items"].withColumn("quantity", F.col("quantity") - 1)
    broken["shipments"] = broken["shipments"].withColumn(
        "shipped_at", F.col("shipped_at") + F.make_dt_interval((F.col("shipment_id") % 7).cast("int")))
    return reduce(DataFrame.unionByName, [
        checks.broken_rows(broken[name], ENTITIES[name].key, rules[name]).select(
            F.lit(name).alias("table_name"), "row_key", "rule")
        for name in TABLES
    ])


def check_run_rules(spark, sf):
    """Row rules of the run audit."""
    return checks.broken_rows(tables.audited_runs(spark, sf), "run_id", checks.row_rules()["pipeline_runs"])


def _after_deletes(spark, sf):
    """The source tables with the deletes of their change logs applied to
    customers and products."""
    return tables.entities(spark, sf) | {
        name: stored(_current(spark, sf, name).select(*ENTITIES[name].columns), name) for name in ("customers", "products")}


def integrity_report(spark, sf):
    return checks.source_integrity(_after_deletes(spark, sf))


def dataset_problems(spark, sf):
    return checks.dataset_problems(_after_deletes(spark, sf))


def table_fingerprint(spark, sf):
    return reduce(DataFrame.unionByName, [
        agg.fingerprint(frame, ENTITIES[name].columns).select(
            F.lit(name).alias("table_name"), "row_count",
            *[F.col(c).cast("string").alias(c) for c in ("content_sum", "content_sum_low")])
        for name, frame in tables.entities(spark, sf).items()
    ])


def source_profile(spark, sf):
    source = tables.entities(spark, sf)
    return profiles.source_profile(source, checks.source_integrity(source))


# ---- reliability ------------------------------------------------------------

def schema_drift(spark, sf):
    return policy.schema_drift(tables.drifting_records(spark, sf)).drop("record_json")


def _shifted(valid: DataFrame) -> DataFrame:
    n = F.col("kafka_offset")
    shift = F.when(n % 53 == 0, 7_200_000).when(n % 11 == 0, 240_000).otherwise(0)
    return valid.withColumn("source_timestamp_ms", F.col("source_timestamp_ms") - shift)


def _with_lateness(spark, sf):
    return _shifted(_valid(spark, sf))


def event_order(spark, sf):
    return policy.event_order(_with_lateness(spark, sf)).select(
        "kafka_offset", "order_status", "event_delay_seconds", "is_out_of_order", "is_late", "requires_backfill")


def out_of_order(spark, sf):
    return policy.out_of_order(_with_lateness(spark, sf), "source_timestamp_ms").select(
        "kafka_topic", "kafka_partition", "kafka_offset", "source_timestamp_ms", "previous_timestamp_ms")


def offset_gaps(spark, sf):
    return policy.offset_gaps(tables.gapped_log(spark, sf))


def stage_latency(spark, sf):
    return policy.stage_latency(_timed(spark, sf))


def freshness(spark, sf):
    """Age of the newest event per table at a fixed time."""
    newest = _timed(spark, sf).groupBy("source_table").agg(F.max("warehouse_loaded_at").alias("at"))
    return newest.select(
        "source_table", policy.freshness(F.col("at"), policy.utc_literal(CHECKED_AT)).alias("age_seconds"))


def latency_percentiles(spark, sf):
    return agg.exact_percentiles(agg.connector_latency(_valid(spark, sf)))


def latency_percentiles_approx(spark, sf):
    return agg.approximate_percentiles(agg.connector_latency(_valid(spark, sf)))


def reconciliation(spark, sf):
    """Source rows against current state after all changes, per table."""
    return policy.reconcile_counts(
        agg.table_counts(tables.entities(spark, sf)),
        agg.table_counts({name: current_keys(_raw_log(spark, sf, name), name) for name in TABLES}))


def event_reconciliation(spark, sf):
    """Events per table against those of a first load."""
    def counted(frame):
        return frame.groupBy(F.col("source_table").alias("table_name")).agg(F.count("*").alias("row_count"))
    return policy.reconcile_counts(counted(_valid(spark, sf)), counted(_first_load(spark, sf)))


def completeness(spark, sf):
    """How far the change topics cover the source tables."""
    topics = reduce(DataFrame.unionByName, [
        tables.change_records(spark, sf, name).groupBy("topic").agg(F.count("*").alias("row_count")).select(
            F.regexp_extract("topic", r"([^.]+)$", 1).alias("table_name"), "row_count")
        for name in TABLES
    ])
    return policy.completeness(agg.table_counts(tables.entities(spark, sf)), topics)


def change_sequence(spark, sf):
    """Do customers read first go through u, d, c and stay?"""
    log = staging.typed_events(staging.normalised_events(_raw_log(spark, sf, "customers")), "customers")
    return policy.change_sequence(
        log.filter(F.col("operation") != "r"), "customer_id", ("u", "d", "c"),
        _current(spark, sf, "customers"))


def slo_checks(spark, sf):
    raw, bronze = _timed(spark, sf), _bronze(spark, sf)
    counted = agg.table_counts({"bronze_events": events.valid_events(bronze)})
    return profiles.reliability_checks(
        profiles.bronze_profile(events.valid_events(bronze), events.quarantined_events(bronze)), raw,
        event_reconciliation(spark, sf), policy.reconcile_counts(counted, agg.table_counts({"bronze_events": raw})),
        tables.audited_runs(spark, sf), policy.stage_latency(raw), topic_summary(spark, sf),
        policy.utc_literal(CHECKED_AT))


def bronze_profile(spark, sf):
    bronze = _bronze(spark, sf, replays=True)
    return profiles.bronze_profile(events.valid_events(bronze), events.quarantined_events(bronze))


def null_counts(spark, sf):
    """NULLs per metadata column over all events, invalid ones included."""
    return agg.null_counts(_bronze(spark, sf), REQUIRED_METADATA)


def raw_quality(spark, sf):
    return profiles.raw_quality(_bronze(spark, sf, replays=True))


def metadata_counts(spark, sf):
    return profiles.metadata_summary(_valid(spark, sf))


def distinct_counts(spark, sf):
    return agg.distinct_counts(_valid(spark, sf), {
        "topics": ["kafka_topic"], "topic_partitions": ["kafka_topic", "kafka_partition"],
        "days": ["event_date"], "table_days": ["source_table", "event_date"]})


def warehouse_profile(spark, sf):
    # counts and sums, or joins that shuffle by keys of their own: nothing here is worth dealing out first
    states = _states(spark, sf, deal=False)
    facts = build_star(states, _first_versions(spark, sf, deal=False))
    daily = _daily(facts | {"fact_orders": _order_facts(spark, sf, states["orders"])})
    star_tables = facts | {
        "snap_customers": _history(spark, sf),
        # a row a day, used twice
        "mart_daily_commerce": stored(daily, "daily"),
        "mart_customer_value": marts.mart_customer_value(facts["dim_customers"], facts["fact_orders"]),
        "mart_product_performance": marts.mart_product_performance(facts["dim_products"], facts["fact_order_items"]),
    }
    return profiles.warehouse_profile(star_tables, current=states)


def audit_profile(spark, sf):
    return profiles.audit_profile(tables.audited_runs(spark, sf), mart_daily(spark, sf))


def audit_checks(spark, sf):
    """Audit checks against the sizes of the orders table, and a value that the
    mart does not have."""
    orders = tables.orders(spark, sf)
    days = orders.agg(F.countDistinct(F.to_date("ordered_at"))).scalar()
    return profiles.audit_checks(audit_profile(spark, sf), days, orders.agg(F.count("*")).scalar(), F.lit(0))


def recovered_failures(spark, sf):
    return audit.recovered_failures(tables.audited_runs(spark, sf))


def run_audit(spark, sf):
    """The run log folded to one row per run."""
    runs = audit.runs_from_log(tables.run_log(spark, sf))
    entries = F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return runs.withColumn("details", entries)


def run_lookup(spark, sf):
    """One run of the log, as an operator asks for it."""
    run = audit.fetch_run(tables.run_log(spark, sf), LOOKED_UP)
    entries = F.transform(F.array_sort(F.map_entries("details")), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return run.withColumn("details", entries)


def position_problems(spark, sf):
    """Records that cannot have an id, with what is wrong with their position: every 31st has a blank topic, every 37th a
    negative partition, every 41st a negative offset."""
    n = F.col("offset")
    topic = F.when(n % 31 == 0, F.lit(" ")).otherwise(F.col("topic"))
    partition = F.when(n % 37 == 0, F.lit(-1)).otherwise(F.col("partition"))
    offset = F.when(n % 41 == 0, F.lit(-1).cast("long")).otherwise(n)
    problem = position_problem(topic, partition, offset)
    return tables.stream_records(spark, sf).select(n.alias("kafka_offset"), problem.alias("problem")).filter("problem IS NOT NULL")


def load_audit(spark, sf):
    """What the audit table says of a load on disk and of the same load again."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    bronze = stored(_valid(spark, sf, replays=True), "bronze")
    for run in ("first", "again"):
        load_bronze(lake, bronze, run)
    return lake.read("audit", "warehouse_load_runs").drop("started_at", "completed_at")


def dashboard_cards(spark, sf):
    raw, bronze = _timed(spark, sf), _bronze(spark, sf)
    deployment = tables.table(spark, sf, "region").select(
        F.col("r_name").alias("check_name"), F.lit(True).alias("passed"))
    age = raw.agg(policy.freshness(F.max("warehouse_loaded_at"), policy.utc_literal(CHECKED_AT)).alias("age_seconds"))
    return profiles.dashboard_cards(
        slo_checks(spark, sf), deployment, event_reconciliation(spark, sf), profiles.raw_quality(raw),
        profiles.bronze_profile(events.valid_events(bronze), events.quarantined_events(bronze)), age)


# ---- streaming --------------------------------------------------------------

# Readers split a file between its row groups, of which one of usual size may hold all records of a micro-batch.
RECORD_GROUP_BYTES = 2 * 1024 * 1024


def _arrive(records: DataFrame, path: str) -> None:
    """Appends record files that every core can read a part of."""
    records.write.mode("append").option("parquet.block.size", RECORD_GROUP_BYTES).parquet(path)


def _staged_stream(spark, sf) -> tuple[str, BronzePaths]:
    """The record files a stream reads, and what it writes."""
    root = scratch_path(spark, "stream")
    return f"{root}/records", BronzePaths.below(root)


def stream_bronze(spark, sf):
    """Both layers after the stream has drained its files, as one frame."""
    source, paths = _staged_stream(spark, sf)
    _arrive(tables.stream_records(spark, sf), source)
    run_bronze_stream(records.file_stream(spark, source), paths, RUN_ID)
    columns = ["event_id", "source_table", "operation", "kafka_offset", "event_date", "invalid_reason"]
    return read_bronze(spark, paths).select(*columns).unionByName(read_quarantine(spark, paths).select(*columns))


def stream_resume(spark, sf):
    """Three runs on one checkpoint: half the records, nothing new, the rest."""
    source, paths = _staged_stream(spark, sf)
    arrivals = tables.stream_records(spark, sf)
    even = F.col("offset") % 2 == 0
    reports = []
    for n, batch in enumerate([arrivals.filter(even), None, arrivals.filter(~even)], start=1):
        if batch is not None:
            _arrive(batch, source)
        rows = run_bronze_stream(records.file_stream(spark, source, max_files=2), paths, f"run-{n}")
        reports.append(stream_report(spark, paths, f"run-{n}").select(
            F.lit(n).cast("long").alias("run"),
            F.lit(rows["valid_input_rows"]).cast("long").alias("input_rows"),
            "new_bronze_events", "new_quarantine_events", "duplicate_event_ids"))
        # the next run appends to what this report counts
        reports[-1] = stored(reports[-1], "report")
    return reduce(DataFrame.unionByName, reports)


def stream_dedup(spark, sf):
    """Repeated deliveries dropped while streaming."""
    source, paths = _staged_stream(spark, sf)
    _arrive(tables.stream_records(spark, sf, replays=True), source)
    unique = dedup.dedup_stream(
        events.valid_events(events.bronze_events(records.file_stream(spark, source), RUN_ID)))
    query = (unique.writeStream.format("parquet").option("path", paths.bronze)
             .option("checkpointLocation", paths.checkpoints).trigger(availableNow=True).start())
    query.awaitTermination()
    return read_bronze(spark, paths).select("event_id", "source_table", "operation", "kafka_offset")


def stream_event_order(spark, sf):
    """The classes of ``event_order`` found while streaming, over three runs on one checkpoint."""
    root = scratch_path(spark, "order")
    arrivals = stored(tables.stream_records(spark, sf), "records")
    last = arrivals.agg(F.max("offset")).first()[0] or 0
    for run in range(3):
        third = arrivals.filter(F.least(F.floor(F.col("offset") * 3 / (last + 1)), F.lit(2)) == run)
        _arrive(third, f"{root}/records")
        valid = events.valid_events(events.bronze_events(records.file_stream(spark, f"{root}/records"), RUN_ID))
        # what the classes are found by; the stream writes every column it is given
        timed = _shifted(valid).select("kafka_topic", "kafka_partition", "kafka_offset", "source_timestamp_ms")
        start_order_stream(timed, f"{root}/order", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/order/classes").select(
        "kafka_offset", "order_status", "event_delay_seconds", "is_out_of_order", "is_late", "requires_backfill")


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        event_ids, event_validity, quarantine_counts, strict_validity, record_keys, topic_summary, dedup_events,
        duplicate_summary, incremental_new_events, load_verification, scd2_history, dim_customers, scd_checks,
        scd_overlaps, scd_open_versions, dim_products, fact_orders_asof, mart_daily, mart_daily_scope,
        mart_daily_backfill, mart_customer_value, mart_customer_value_from_changes, mart_product_performance,
        mart_daily_from_changes, mart_product_performance_from_changes, check_unique, check_not_null, check_accepted, check_relationships, check_item_totals, check_payment_totals,
        check_daily_reconcile, check_rows, check_run_rules, integrity_report, dataset_problems, table_fingerprint,
        source_profile, schema_drift, event_order, out_of_order, stage_latency, freshness, latency_percentiles,
        latency_percentiles_approx, reconciliation, event_reconciliation, completeness, change_sequence, slo_checks,
        bronze_profile, null_counts, raw_quality, metadata_counts, distinct_counts, warehouse_profile, audit_profile,
        audit_checks, recovered_failures, run_audit, dashboard_cards, stream_bronze, stream_resume, stream_dedup,
        fact_orders_interleaved, customer_event_history, offset_gaps, stream_event_order, incremental_build, run_lookup,
        position_problems, load_audit)
}
QUERIES |= {f"typed_{name}": _typed(name) for name in TABLES}
QUERIES |= {f"current_{name}": _current_query(name) for name in TABLES}
QUERIES |= {f"current_{name}_incremental": _incremental_query(name) for name in TABLES}
QUERIES |= {name: _fact(name) for name in ("fact_order_items", "fact_payments", "fact_shipments")}


def catalog() -> dict[str, Query]:
    def ready(query: Query) -> Query:
        return lambda spark, sf_dir: plain(query(use_utc(spark), sf_dir))

    return {name: ready(query) for name, query in QUERIES.items()}
