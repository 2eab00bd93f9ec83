"""Reliability policies: schema drift, lateness, reconciliation, freshness."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.measures import seconds_between
from tidemark.operators.ordered import OFFSETS_PER_BLOCK, offset_block, with_previous, with_running_max
from tidemark.schemas import ALLOWED_LATENESS_SECONDS, ENTITIES


def _per_table(table: Column, value) -> Column:
    """``value(entity)`` of the row's own table, NULL for an unknown one."""
    chain = None
    for entity in ENTITIES.values():
        case = table == entity.name
        chain = F.when(case, value(entity)) if chain is None else chain.when(case, value(entity))
    return chain


def schema_drift(records: DataFrame, table: str = "source_table", record: str = "record_json") -> DataFrame:
    """Compares every record with the field set expected for its table.

    Adds ``compatible``, ``change_type`` (unchanged, additive, incompatible),
    ``drift_reason`` and sorted ``missing_fields`` and ``extra_fields``. The
    key must be a 64-bit JSON integer; text or a boolean is incompatible.
    """
    source = F.col(table)
    shaped = records.withColumns({
        "_doc": F.try_parse_json(record),
        "_expected": _per_table(source, lambda e: F.array(*[F.lit(c) for c in sorted(e.columns)])),
        "_key": _per_table(source, lambda e: F.lit(e.key)),
    }).withColumns({
        "_is_object": F.coalesce(F.schema_of_variant("_doc").startswith("OBJECT"), F.lit(False)),
        "_actual": F.json_object_keys(record),
        "_key_type": _per_table(
            source, lambda e: F.schema_of_variant(F.try_variant_get("_doc", f"$.{e.key}", "variant"))),
    })
    none = F.array().cast("array<string>")
    known, is_object = F.col("_expected").isNotNull(), F.col("_is_object")
    missing = F.when(known & is_object, F.array_sort(F.array_except("_expected", "_actual"))).when(
        known, F.col("_expected")).otherwise(none)
    extra = F.when(known & is_object, F.array_sort(F.array_except("_actual", "_expected"))).otherwise(none)
    judged = shaped.withColumns({"missing_fields": missing, "extra_fields": extra})
    reason = (
        F.when(~known, "unexpected_source_table")
        .when(~is_object, "record_not_object")
        .when(~F.array_contains("_actual", F.col("_key")), "missing_primary_key")
        .when(F.coalesce(F.col("_key_type"), F.lit("VOID")) != "BIGINT", "incompatible_primary_key_type")
        .when(F.size("missing_fields") > 0, "missing_expected_fields")
    )
    return judged.withColumn("drift_reason", reason).select(
        *records.columns,
        F.col("drift_reason").isNull().alias("compatible"),
        F.when(F.col("drift_reason").isNotNull(), "incompatible")
        .when(F.size("extra_fields") > 0, "additive")
        .otherwise("unchanged").alias("change_type"),
        "drift_reason", "missing_fields", "extra_fields",
    )


def order_class(event_at: Column, watermark: Column, allowed_seconds: float = ALLOWED_LATENESS_SECONDS) -> dict:
    """Lateness columns of an event against a high watermark, both timestamps.
    Exactly ``allowed_seconds`` behind is not yet late."""
    if allowed_seconds < 0:
        raise ValueError("allowed lateness cannot be negative")
    behind = seconds_between(event_at, watermark)
    delay = F.greatest(F.coalesce(behind, F.lit(0).cast("decimal(18,3)")), F.lit(0).cast("decimal(18,3)"))
    micros = F.unix_micros(watermark) - F.unix_micros(event_at)
    late = F.coalesce(micros > int(allowed_seconds * 1_000_000), F.lit(False))
    disordered = F.coalesce(event_at < watermark, F.lit(False))
    return {
        "order_status": F.when(late, "late").when(disordered, "out_of_order").otherwise("on_time"),
        "event_delay_seconds": delay,
        "is_out_of_order": disordered,
        "is_late": late,
        "requires_backfill": late,
    }


def event_order(
    events: DataFrame, time: str = "source_timestamp_ms", allowed_seconds: float = ALLOWED_LATENESS_SECONDS,
    block_size: int = OFFSETS_PER_BLOCK,
) -> DataFrame:
    """Classifies every event against the newest event before it in its topic
    partition."""
    marked = with_running_max(
        events, ["kafka_topic", "kafka_partition"], "kafka_offset", time, offset_block("kafka_offset", block_size),
        "_watermark")
    return marked.withColumns(order_class(
        F.timestamp_millis(time), F.timestamp_millis("_watermark"), allowed_seconds)).drop("_watermark")


def out_of_order(
    events: DataFrame, time: str = "connector_timestamp_ms", block_size: int = OFFSETS_PER_BLOCK
) -> DataFrame:
    """Events older than the one right before them in their topic partition."""
    timed = events.filter(F.col(time).isNotNull())
    previous = with_previous(
        timed, ["kafka_topic", "kafka_partition"], "kafka_offset", time, offset_block("kafka_offset", block_size),
        "previous_timestamp_ms")
    return previous.filter(F.col(time) < F.col("previous_timestamp_ms"))


def offset_gaps(
    records: DataFrame, keys: tuple[str, ...] = ("kafka_topic", "kafka_partition"), offset: str = "kafka_offset",
    block_size: int = OFFSETS_PER_BLOCK,
) -> DataFrame:
    """``first_missing``, ``last_missing`` and ``missing`` of every run of offsets that a topic partition lacks between its first
    and its last; offsets that came twice make up for nothing. Records without key or offset are left out."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys, offset)])
    present = records.filter(whole).select(*keys, F.col(offset).alias("_offset")).distinct()
    before = with_previous(present, keys, "_offset", "_offset", offset_block("_offset", block_size), "_previous")
    return before.filter(F.col("_offset") - F.col("_previous") > 1).select(
        *keys, (F.col("_previous") + 1).alias("first_missing"), (F.col("_offset") - 1).alias("last_missing"),
        (F.col("_offset") - F.col("_previous") - 1).alias("missing"))


def reconciliation(source: str, target: str) -> dict[str, Column]:
    """Difference columns of two counts; a negative count is an error."""
    a, b = F.col(source), F.col(target)
    difference = F.when(
        (a < 0) | (b < 0), F.raise_error(F.lit("record counts cannot be negative")).cast("long")
    ).otherwise(b - a)
    return {
        "difference": difference,
        "missing_records": F.greatest(-difference, F.lit(0).cast("long")),
        "unexpected_records": F.greatest(difference, F.lit(0).cast("long")),
        "reconciled": difference == 0,
    }


def reconcile_counts(source: DataFrame, target: DataFrame) -> DataFrame:
    """Joins two ``(table_name, row_count)`` frames; a table one side lacks
    counts as 0."""
    left = source.select("table_name", F.col("row_count").alias("source_count"))
    right = target.select("table_name", F.col("row_count").alias("target_count"))
    both = left.join(right, "table_name", "full_outer").select(
        "table_name",
        F.coalesce("source_count", F.lit(0)).cast("long").alias("source_count"),
        F.coalesce("target_count", F.lit(0)).cast("long").alias("target_count"),
    )
    return both.withColumns(reconciliation("source_count", "target_count"))


def utc_literal(moment: datetime) -> Column:
    """A zoned Python time as a literal; a naive one is an error."""
    if moment.tzinfo is None:
        raise ValueError("datetime values must include timezone information")
    return F.timestamp_micros(F.lit(int(round(moment.timestamp() * 1_000_000))))


def freshness(observed_at: Column, checked_at: Column) -> Column:
    """Age in seconds; a future observation has age 0."""
    zero = F.lit(0).cast("decimal(18,3)")
    return F.greatest(seconds_between(observed_at, checked_at), zero)


def recovery(failed_at: Column, recovered_at: Column) -> Column:
    """Seconds from failure to recovery; recovery before failure is an error."""
    return F.when(
        recovered_at < failed_at,
        F.raise_error(F.lit("recovery cannot occur before failure")).cast("decimal(18,3)"),
    ).otherwise(seconds_between(failed_at, recovered_at))


def completeness(source: DataFrame, topics: DataFrame) -> DataFrame:
    """One row: how completely topics cover their source tables. A table with
    no source rows counts as complete."""
    joined = source.select("table_name", F.col("row_count").alias("source_rows")).join(
        topics.select("table_name", F.col("row_count").alias("topic_events")), "table_name", "left"
    ).withColumn("topic_events", F.coalesce("topic_events", F.lit(0)))
    ratio = F.when(
        F.col("source_rows") > 0,
        F.col("topic_events").cast("decimal(20,0)") / F.col("source_rows").cast("decimal(20,0)"))
    return joined.agg(
        F.sum("source_rows").alias("total_source_rows"),
        F.sum("topic_events").alias("total_topic_events"),
        F.round(F.min(ratio), 6).alias("minimum_completeness_rate"),
        F.bool_and(F.col("topic_events") == F.col("source_rows")).alias("exact_initial_snapshot_match"),
        F.bool_and(F.col("topic_events") >= F.col("source_rows")).alias("complete"),
    )


def stage_latency(events: DataFrame) -> DataFrame:
    """Average and maximum milliseconds per stage, negatives clamped to 0."""
    zero = F.lit(0).cast("decimal(20,3)")
    source = F.col("source_timestamp_ms").cast("decimal(20,3)")
    connector = F.col("connector_timestamp_ms").cast("decimal(20,3)")
    ingested = (F.unix_micros("ingested_at").cast("decimal(20,0)") / 1000).cast("decimal(20,3)")
    loaded = (F.unix_micros("warehouse_loaded_at").cast("decimal(20,0)") / 1000).cast("decimal(20,3)")
    stages = {
        "connector": connector - source,
        "bronze_processing": ingested - connector,
        "warehouse_load": loaded - ingested,
        "end_to_end": loaded - source,
    }
    measured = events.filter(
        F.col("source_timestamp_ms").isNotNull() & F.col("connector_timestamp_ms").isNotNull()
    ).select(*[F.greatest(gap, zero).cast("decimal(20,3)").alias(name) for name, gap in stages.items()])
    columns = [F.count("*").alias("measured_events")]
    for name in stages:
        columns.append(F.round(
            F.sum(name).cast("decimal(30,3)") / F.count(name), 3).cast("decimal(20,3)").alias(f"{name}_average"))
        columns.append(F.max(name).alias(f"{name}_maximum"))
    return measured.agg(*columns)


def change_sequence(
    events: DataFrame, key: str, expected: tuple[str, ...] = ("c", "u", "d"), remaining: DataFrame | None = None
) -> DataFrame:
    """Per key: are its events, in offset order, exactly ``expected``?

    All events of a key are counted, and as many of the first as expected are
    compared one by one: together that decides for any number of events. The
    rank filter limits a hot key ahead of the shuffle, counting combines before
    it. With ``remaining`` (rows still present) a key that is still there fails
    as well.
    """
    limit = len(expected)
    order = Window.partitionBy(key).orderBy("kafka_offset", "event_id")
    first = events.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= limit)
    # one small map entry per rank, at most `limit` of them
    begun = first.groupBy(key).agg(*[
        F.max(F.when(F.col("_n") == n, F.col("operation"))).alias(f"_op{n}") for n in range(1, limit + 1)
    ]).select(key, F.concat_ws(",", *[f"_op{n}" for n in range(1, limit + 1)]).alias("first_operations"))
    seen = events.groupBy(key).agg(F.count("*").alias("event_count")).join(begun, key)
    if remaining is None:
        judged = seen.withColumn("remaining_rows", F.lit(0).cast("long"))
    else:
        left = remaining.groupBy(key).agg(F.count("*").alias("remaining_rows"))
        judged = seen.join(left, key, "left").withColumn(
            "remaining_rows", F.coalesce("remaining_rows", F.lit(0)).cast("long"))
    return judged.withColumn(
        "verified", (F.col("first_operations") == ",".join(expected)) & (F.col("event_count") == limit)
        & (F.col("remaining_rows") == 0))
