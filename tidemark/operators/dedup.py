"""Exactly-once loading: dedup, anti-join against the target, verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.current import latest_per_key
from tidemark.schemas import RAW_SCHEMA


def dedup_events(events: DataFrame, key: str = "event_id") -> DataFrame:
    """One row per key, the first delivery.

    A fixed choice, unlike an arbitrary one, gives the same rows again when a
    lost executor makes Spark recompute part of the data.
    """
    order = [F.col("ingested_at").asc_nulls_last(), F.col("ingestion_run_id").asc_nulls_last()]
    return latest_per_key(events, [key], order)


def dedup_stream(events: DataFrame, key: str = "event_id", arrived: str | None = None, within: str = "1 hour") -> DataFrame:
    """Streaming variant; never drops anything but repeats.

    Every key is remembered, whenever its event is dated (a state store on disk
    holds many). Where a column says when an event ``arrived`` and never runs
    back, keys are forgotten ``within`` that time: a repeat beyond it comes
    through and is left to the load, and no event is late by its own date.
    """
    if arrived is None:
        return events.dropDuplicates([key])
    return events.withWatermark(arrived, within).dropDuplicatesWithinWatermark([key])


def duplicate_count(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows, distinct keys and their difference."""
    per_key = events.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count(key).alias("distinct_count"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count(key)).alias("duplicate_count"),
    )


def new_events(source: DataFrame, target: DataFrame, key: str = "event_id") -> DataFrame:
    """Source rows whose key the target lacks.

    Ids are long and target sizes are guessed from compressed files, so that a
    target of many ids may pass for one to broadcast: it never goes through the
    driver, and rows meet by a sort on the key.
    """
    return source.join(target.select(key).hint("merge"), key, "left_anti")


PARTITION = ("source_table", "event_date")


def touched_partitions(batch: DataFrame) -> DataFrame:
    """The exact partitions the batch lies in. An event always lands in the same
    partition, so only these can hold copies of it."""
    return batch.select(*PARTITION).distinct()


def in_partitions(target: DataFrame, touched: DataFrame) -> DataFrame:
    """The rows of ``target`` in the touched partitions, by an equi-join on the
    partition columns, so that Spark reads no others. Events without a date have
    a partition of their own, which is read whenever it exists."""
    whole = [F.col(c).isNotNull() for c in PARTITION]
    dated = target.filter(whole[0] & whole[1]).join(touched, list(PARTITION), "left_semi")
    return dated.select(*target.columns).unionByName(target.filter(~(whole[0] & whole[1])))


def stamped(events: DataFrame, loaded_at: Column | None = None) -> DataFrame:
    """Adds the load time and puts columns in table order."""
    return events.withColumn(
        "warehouse_loaded_at", F.current_timestamp() if loaded_at is None else loaded_at
    ).select(*RAW_SCHEMA.fieldNames())


def load_verification(
    source: DataFrame, target: DataFrame, inserted: int | None = None, existing: int | None = None
) -> DataFrame:
    """One row: counts of source and target ids, duplicates and missing ids.

    Both sides are counted per id first; a full outer join on the id then gives
    every figure in one pass. ``source`` is expected deduplicated.
    """
    left = source.groupBy("event_id").agg(F.count("*").alias("s"))
    right = target.groupBy("event_id").agg(F.count("*").alias("t"))
    both = left.join(right, "event_id", "full_outer")
    report = both.agg(
        F.coalesce(F.sum("s"), F.lit(0)).alias("source_record_count"),
        F.coalesce(F.sum(F.col("s") - 1), F.lit(0)).alias("source_duplicate_event_ids"),
        F.coalesce(F.sum("t"), F.lit(0)).alias("target_record_count"),
        F.coalesce(F.sum(F.col("t") - 1), F.lit(0)).alias("target_duplicate_event_ids"),
        F.count_if(F.col("s").isNotNull() & F.col("t").isNull()).alias("missing_target_records"),
    )
    if inserted is None:
        return report
    return report.withColumns({
        "inserted_record_count": F.lit(inserted).cast("long"),
        "existing_record_count": F.lit(existing).cast("long"),
        "valid": (F.col("source_duplicate_event_ids") == 0)
        & (F.col("missing_target_records") == 0)
        & (F.col("target_duplicate_event_ids") == 0)
        & (F.lit(inserted + existing) == F.col("source_record_count")),
    })


def load_audit_row(
    spark: SparkSession, run_id: str, started_at, completed_at, source: int, inserted: int, existing: int,
    name: str = "bronze_to_warehouse", status: str = "succeeded", failed: int = 0,
) -> DataFrame:
    return spark.range(1).select(
        F.lit(run_id).alias("run_id"),
        F.lit(name).alias("pipeline_name"),
        F.lit(status).alias("status"),
        F.lit(started_at).cast("timestamp").alias("started_at"),
        F.lit(completed_at).cast("timestamp").alias("completed_at"),
        F.lit(source).cast("long").alias("source_record_count"),
        F.lit(inserted).cast("long").alias("inserted_record_count"),
        F.lit(existing).cast("long").alias("existing_record_count"),
        F.lit(failed).cast("long").alias("failed_record_count"),
    )
