"""From stream records to bronze events (lenient validity)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import envelope_field, parse_envelope, parsed_once, payload_text
from tidemark.functions.keys import event_id
from tidemark.schemas import BRONZE_COLUMNS, OPERATIONS, TABLES


def validity_reason(
    value: Column,
    operation: Column,
    source_table: Column,
    tables: Sequence[str] = TABLES,
    operations: Sequence[str] = OPERATIONS,
) -> Column:
    """First rule a record breaks, NULL for a valid one."""
    return (
        F.when(value.isNull(), "null_kafka_value")
        .when(operation.isNull(), "missing_or_invalid_operation")
        .when(~operation.isin(*operations), "unsupported_operation")
        .when(~source_table.isin(*tables), "unexpected_source_table")
    )


def bronze_events(
    records: DataFrame,
    run_id: str,
    tables: Sequence[str] = TABLES,
    operations: Sequence[str] = OPERATIONS,
) -> DataFrame:
    """Project stream records to the 22 bronze columns.

    Works on batch and streaming frames alike: a pure projection, no shuffle.
    """
    texts = records.select(
        F.col("key").cast("string").alias("key_json"),
        F.col("value").cast("string").alias("value_json"),
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("timestamp").alias("kafka_timestamp"),
    )
    parsed = parsed_once(texts, parse_envelope(F.col("value_json")), "envelope")
    fields = parsed.select(
        "key_json", "value_json", "kafka_topic", "kafka_partition", "kafka_offset", "kafka_timestamp",
        F.regexp_extract("kafka_topic", r"([^.]+)$", 1).alias("source_table"),
        envelope_field("envelope", "op").alias("operation"),
        envelope_field("envelope", "source.ts_ms").try_cast("long").alias("source_timestamp_ms"),
        envelope_field("envelope", "ts_ms").try_cast("long").alias("connector_timestamp_ms"),
        envelope_field("envelope", "source.lsn").try_cast("long").alias("source_lsn"),
        envelope_field("envelope", "source.txId").try_cast("long").alias("source_transaction_id"),
        envelope_field("envelope", "before").alias("before_json"),
        envelope_field("envelope", "after").alias("after_json"),
        payload_text(F.col("value_json")).alias("payload_json"),
        F.col("envelope.schema.name").alias("schema_name"),
    )
    timed = fields.withColumn(
        "event_timestamp",
        F.coalesce(F.timestamp_millis("connector_timestamp_ms"), F.col("kafka_timestamp")),
    )
    return timed.select(
        "*",
        F.to_date("event_timestamp").alias("event_date"),
        event_id(F.col("kafka_topic"), F.col("kafka_partition"), F.col("kafka_offset")).alias("event_id"),
        F.lit(run_id).alias("ingestion_run_id"),
        F.current_timestamp().alias("ingested_at"),
        validity_reason(
            F.col("value_json"), F.col("operation"), F.col("source_table"), tables, operations
        ).alias("invalid_reason"),
    ).select(*BRONZE_COLUMNS)


def valid_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("invalid_reason").isNull())


def quarantined_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("invalid_reason").isNotNull())


def record_key(envelope: str, key_field: str) -> Column:
    """Key of the changed row: from ``after``, else ``before``."""
    image = F.coalesce(envelope_field(envelope, "after"), envelope_field(envelope, "before"))
    return F.get_json_object(image, f"$.{key_field}").try_cast("long")
