"""Type-2 history from the events themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import version_id
from tidemark.operators.current import latest_per_key
from tidemark.operators.ordered import with_previous
from tidemark.schemas import ENTITIES, Entity
from tidemark.sources.lake import stored

BLOCK_MS = 30 * 86_400_000


def history_from_events(typed: DataFrame, entity: Entity | str, block_ms: int = BLOCK_MS) -> DataFrame:
    """Every version an entity's rows went through, by the time of the change at the source.

    A snapshot sees a row as it is when it is taken; what happened since the last
    one is lost. Events lose nothing: of several events of one instant the newest
    counts, neighbours with the same values are one version, a delete opens a
    version flagged deleted with the last values, which a re-creation ends. A
    delete of a key that never was is nothing. An event that comes late has its
    own place, so its neighbours are cut anew whenever the history is computed.
    Keys are read in blocks of ``block_ms``; each has its edges carried over, so
    that a busy key is not one task. Events without key or time are left out.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    key = entity.key
    placed = typed.filter(F.col(key).isNotNull() & F.col("source_timestamp_ms").isNotNull())
    # a delete carries the key alone
    image = F.when(~F.col("is_deleted"), F.struct(*entity.columns))
    events = stored(latest_per_key(placed, [key, "source_timestamp_ms"]).select(
        key, F.col("source_timestamp_ms").alias("_ms"), F.struct("is_deleted", image.alias("image")).alias("_state")), "events_by_time")
    block = F.floor(F.col("_ms") / F.lit(block_ms))
    seen = with_previous(events, [key], "_ms", "_state", block, "_before")
    began = F.col("_before").isNull() & ~F.col("_state.is_deleted")
    turned = F.col("_before").isNotNull() & ~F.col("_state").eqNullSafe(F.col("_before"))
    kept = stored(seen.filter(began | turned), "versions_by_time")
    ended = with_previous(kept, [key], "_ms", "_ms", block, "_next", descending=True)
    values = F.coalesce("_state.image", "_before.image")
    rows = ended.select(
        values.alias("v"), F.timestamp_millis("_ms").alias("valid_from"), F.timestamp_millis("_next").alias("valid_to"),
        F.col("_state.is_deleted").alias("is_deleted")).select("v.*", "valid_from", "valid_to", "is_deleted")
    return rows.select(
        *entity.columns, version_id(F.col(key), F.col("valid_from"), F.col("is_deleted")).alias("scd_id"), "valid_from", "valid_to",
        "is_deleted")
