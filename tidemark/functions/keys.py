"""Deterministic ids and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_id(topic: Column, partition: Column, offset: Column) -> Column:
    """SHA-256 of ``topic:partition:offset``, 64 hex digits."""
    return F.sha2(F.concat_ws(":", topic, partition.cast("string"), offset.cast("string")), 256)


def checked_event_id(topic: Column, partition: Column, offset: Column) -> Column:
    """As :func:`event_id`, but a blank topic or a negative position is an error."""
    return (
        F.when(F.coalesce(F.trim(topic), F.lit("")) == "", F.raise_error(F.lit("topic cannot be empty")))
        .when(partition < 0, F.raise_error(F.lit("partition cannot be negative")))
        .when(offset < 0, F.raise_error(F.lit("offset cannot be negative")))
        .otherwise(event_id(topic, partition, offset))
    )


def position_problem(topic: Column, partition: Column, offset: Column) -> Column:
    """Name of what is wrong with a record position, NULL where it is sound."""
    return (
        F.when(F.coalesce(F.trim(topic), F.lit("")) == "", F.lit("empty_topic"))
        .when(partition < 0, F.lit("negative_partition"))
        .when(offset < 0, F.lit("negative_offset"))
    )


def surrogate_key(natural: Column) -> Column:
    return F.md5(natural.cast("string"))


def zoned_text(moment: Column) -> Column:
    """A UTC timestamp as text with its zone: ``2024-01-01 08:00:00.12+00``."""
    return F.concat(moment.cast("string"), F.lit("+00"))


def version_key(natural: Column, valid_from: Column) -> Column:
    """Key of one version of a dimension member."""
    return F.md5(F.concat(natural.cast("string"), F.lit("|"), zoned_text(valid_from)))


def version_id(natural: Column, updated_at: Column, marker: Column) -> Column:
    """Id of a history row. A delete marker may start at the very moment a live
    version does, so the flag is part of the id."""
    return F.md5(F.concat_ws(
        "|", natural.cast("string"), zoned_text(updated_at), F.when(marker, F.lit("deleted"))))
