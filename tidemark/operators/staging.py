"""Normalised records and the typed projection of every entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.envelope import parsed_once
from tidemark.schemas import ENTITIES, LINEAGE_COLUMNS, Entity


def _filled(column: str) -> Column:
    return F.nullif(F.col(column), F.lit(""))


def normalised_events(raw: DataFrame) -> DataFrame:
    """``record_json`` is the row after the change, or before it for deletes."""
    return raw.withColumns({
        "is_deleted": F.col("operation") == "d",
        "key_json": _filled("key_json"),
        "before_json": _filled("before_json"),
        "after_json": _filled("after_json"),
        "record_json": F.coalesce(_filled("after_json"), _filled("before_json")),
    })


def _typed(field: T.StructField) -> Column:
    text = F.col(f"_record.{field.name}")
    if isinstance(field.dataType, T.StringType):
        return text
    return F.nullif(text, F.lit("")).try_cast(field.dataType)


def typed_events(events: DataFrame, entity: Entity | str, columns: Sequence[str] | None = None) -> DataFrame:
    """Events of one entity with typed columns, all or the named ones.

    The record is parsed once into text fields. A value that does not cast
    becomes NULL and its column is listed in ``cast_failed``, so a bad row is
    reported instead of failing everything behind it. The filter on
    ``source_table`` prunes partitions of the raw table.
    """
    entity = ENTITIES[entity] if isinstance(entity, str) else entity
    fields = [f for f in entity.schema.fields if columns is None or f.name in columns]
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    own = events.filter(F.col("source_table") == entity.name)
    parsed = parsed_once(own, F.from_json("record_json", texts), "_record")
    typed = parsed.select("*", *[_typed(field).alias(field.name) for field in fields])
    # names that are not empty; taking out is compiled, unlike a filter by a lambda
    failed = F.array_remove(F.array(*[
        F.when(F.nullif(F.col(f"_record.{f.name}"), F.lit("")).isNotNull() & F.col(f.name).isNull(), f.name).otherwise("")
        for f in fields if not isinstance(f.dataType, T.StringType)
    ]), "")
    return typed.select("event_id", "operation", "is_deleted", *[f.name for f in fields], failed.alias("cast_failed"), *LINEAGE_COLUMNS)
