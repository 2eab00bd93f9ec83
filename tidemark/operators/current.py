"""Latest state of every key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.staging import normalised_events, typed_events
from tidemark.schemas import ENTITIES, Entity


def newest_first() -> list[Column]:
    """Change order: source time, arrival time, offset, id."""
    return [
        F.col("source_timestamp_ms").desc_nulls_last(),
        F.col("kafka_timestamp").desc_nulls_last(),
        F.col("kafka_offset").desc(),
        F.col("event_id").desc(),
    ]


def latest_per_key(events: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key, the first in ``order``.

    The rank filter becomes a group limit ahead of the shuffle: each map task
    sends at most one row per key, however many events a hot key has.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or newest_first()))
    return events.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def current_state(typed: DataFrame, entity: Entity | str) -> DataFrame:
    """Latest version of every key that is not deleted.

    Deletes are dropped after ranking, so a delete hides its key and a later
    re-creation shows it again.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    return live_rows(latest_per_key(typed, [entity.key]), entity)


def live_rows(newest: DataFrame, entity: Entity | str) -> DataFrame:
    """Current state from the newest event of every key."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    return newest.filter(~F.col("is_deleted")).select(
        *entity.columns,
        F.col("event_id").alias("current_event_id"),
        F.col("operation").alias("latest_operation"),
        F.col("event_timestamp").alias("source_event_at"),
        "kafka_partition", "kafka_offset", "warehouse_loaded_at",
    )


def current_from_raw(raw: DataFrame, entity: Entity | str) -> DataFrame:
    return current_state(typed_events(normalised_events(raw), entity), entity)


def current_keys(raw: DataFrame, entity: Entity | str) -> DataFrame:
    """The keys of the current state, for counts: of a record only the key is read."""
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    typed = typed_events(normalised_events(raw), entity, [entity.key])
    return latest_per_key(typed, [entity.key]).filter(~F.col("is_deleted")).select(entity.key)
