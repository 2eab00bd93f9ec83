"""Bronze to the raw table, exactly once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedup import (
    dedup_events, in_partitions, load_audit_row, load_verification, new_events, stamped, touched_partitions)
from tidemark.plans.refresh import built_until
from tidemark.schemas import BRONZE_COLUMNS, RAW_SCHEMA
from tidemark.sources.lake import Lake, require_columns, stored

RAW_PARTITIONS = ("source_table", "event_date")
# tasks that may share the writing of one partition
WRITERS = 4


@dataclass(frozen=True)
class LoadResult:
    run_id: str
    inserted: int
    report: DataFrame


def load_runs(lake: Lake, bronze: DataFrame, stream_runs: Sequence[str], run_id: str) -> LoadResult:
    """Loads and verifies what the named stream runs wrote.

    Files of the stream hold one run each, so the filter on the run id skips all
    others by their footers; a run with nothing new reads nothing.
    """
    return load_bronze(lake, bronze.filter(F.col("ingestion_run_id").isin(list(stream_runs))), run_id)


def load_bronze(lake: Lake, bronze: DataFrame, run_id: str) -> LoadResult:
    """Appends the events the raw table lacks and verifies the outcome. A load that
    dies leaves a failed row in the audit table.

    Target ids are read only from the partitions the batch can touch. Known ids
    are removed before copies of new ones are, so a reload sorts nothing. Rows
    inserted are the growth of the target, counted from Parquet footers.
    """
    started = datetime.now(timezone.utc)
    try:
        return _load(lake, bronze, run_id, started)
    except Exception:
        lake.append(
            load_audit_row(lake.spark, run_id, started, datetime.now(timezone.utc), 0, 0, 0, status="failed"),
            "audit", "warehouse_load_runs")
        raise


def _load(lake: Lake, bronze: DataFrame, run_id: str, started: datetime) -> LoadResult:
    source = require_columns(bronze, BRONZE_COLUMNS).select(*BRONZE_COLUMNS)
    touched = stored(touched_partitions(source), "touched")
    target = in_partitions(lake.read_optional("raw", "bronze_events", RAW_SCHEMA), touched)
    before = target.count()
    # later than all that was built from, whatever the clock says
    now = F.greatest(F.current_timestamp(), F.timestamp_micros(F.lit(built_until(lake) + 1)))
    fresh = stamped(dedup_events(new_events(source, target)), now)
    # each task writes into few partitions; large ones are shared by several tasks
    salt = F.pmod(F.xxhash64("event_id"), F.lit(WRITERS))
    lake.append(fresh.repartition(*RAW_PARTITIONS, salt), "raw", "bronze_events", RAW_PARTITIONS)

    loaded = in_partitions(lake.read_optional("raw", "bronze_events", RAW_SCHEMA), touched)
    inserted = loaded.count() - before
    counts = load_verification(source, loaded).withColumn("inserted_record_count", F.lit(inserted).cast("long"))
    report = counts.withColumn(
        # distinct ids of the source
        "source_event_ids", F.col("source_record_count") - F.col("source_duplicate_event_ids")
    ).withColumn("existing_record_count", F.col("source_event_ids") - F.col("inserted_record_count")).withColumn(
        "valid", (F.col("missing_target_records") == 0) & (F.col("target_duplicate_event_ids") == 0)
        & (F.col("existing_record_count") >= 0))
    row = report.first()
    lake.append(
        load_audit_row(
            lake.spark, run_id, started, datetime.now(timezone.utc), row["source_event_ids"], inserted,
            row["existing_record_count"]),
        "audit", "warehouse_load_runs")
    return LoadResult(run_id, inserted, lake.spark.createDataFrame([row], report.schema))
