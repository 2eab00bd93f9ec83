"""Strict validity: the whole envelope is typed before a record is accepted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.envelope import parsed_once
from tidemark.schemas import OPERATIONS, TABLES


def _member(document: str, path: str) -> Column:
    return F.try_variant_get(F.col(document), path, "variant")


def _is_object(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("OBJECT"), F.lit(False))


def strict_validity(
    records: DataFrame,
    value: str = "value_json",
    tables: Sequence[str] = TABLES,
    operations: Sequence[str] = OPERATIONS,
) -> DataFrame:
    """Adds ``valid``, ``strict_reason``, ``strict_operation``, ``strict_table``
    and ``record_json``.

    The table comes from the envelope, not from the topic, and the image the
    operation needs (``before`` for deletes, else ``after``) must be an object.
    Text behind a complete JSON document is accepted, as Spark's parser does.
    """
    # an absent payload means a bare envelope; a present one must be an object
    opened = parsed_once(records, F.try_parse_json(value), "_doc").withColumn(
        "_env", F.coalesce(_member("_doc", "$.payload"), F.col("_doc")))
    facts = opened.select(
        "*",
        F.try_variant_get("_env", "$.op", "string").alias("_op"),
        F.try_variant_get("_env", "$.source.table", "string").alias("_table"),
    ).withColumn(
        "_image",
        F.when(F.col("_op") == "d", _member("_env", "$.before")).otherwise(_member("_env", "$.after")),
    )
    operation, table = F.col("_op"), F.col("_table")
    reason = (
        F.when(F.col("_doc").isNull(), "invalid_json")
        .when(~_is_object(F.col("_doc")), "payload_not_object")
        .when(~_is_object(F.col("_env")), "missing_payload")
        .when(operation.isNull(), "missing_operation")
        .when(~operation.isin(*operations), "unsupported_operation")
        .when(table.isNull(), "missing_source_table")
        .when(~table.isin(*tables), "unexpected_source_table")
        .when(~_is_object(F.col("_image")) & (operation == "d"), "missing_before_record")
        .when(~_is_object(F.col("_image")), "missing_after_record")
    )
    judged = facts.withColumn("strict_reason", reason)
    shaped = F.col("strict_reason").isNull() | ~F.col("strict_reason").isin(
        "invalid_json", "payload_not_object", "missing_payload")
    return judged.select(
        *records.columns,
        F.col("strict_reason").isNull().alias("valid"),
        "strict_reason",
        F.when(shaped, operation).alias("strict_operation"),
        F.when(shaped, table).alias("strict_table"),
        F.when(F.col("strict_reason").isNull(), F.to_json("_image")).alias("record_json"),
    )
