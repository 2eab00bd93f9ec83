"""The bronze stream: one source, a sink for valid and one for invalid events."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.aggregates import one_row
from tidemark.operators.dedup import duplicate_count
from tidemark.operators.events import bronze_events, quarantined_events, valid_events
from tidemark.schemas import BRONZE_SCHEMA
from tidemark.sources.lake import read_optional

BRONZE_PARTITIONS = ("source_table", "event_date")
POLL_SECONDS = 0.5
QUARANTINE_PARTITIONS = ("invalid_reason", "event_date")


@dataclass(frozen=True)
class BronzePaths:
    bronze: str
    quarantine: str
    checkpoints: str

    @classmethod
    def below(cls, root: str) -> "BronzePaths":
        return cls(f"{root}/landing/bronze", f"{root}/quarantine/bronze", f"{root}/checkpoints/bronze")


def start_sink(events: DataFrame, name: str, path: str, checkpoint: str, partition_by: tuple[str, ...]) -> StreamingQuery:
    """Appends everything available now, in rate-limited micro-batches. The file
    sink's commit log keeps output exactly-once across restarts."""
    return (
        events.writeStream.queryName(name).format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by).trigger(availableNow=True).start()
    )


def run_bronze_stream(records: DataFrame, paths: BronzePaths, run_id: str) -> dict[str, int]:
    """Drains the source into both sinks, which run side by side, each with its
    own checkpoint. Returns the input rows either one read."""
    events = bronze_events(records, run_id)
    queries = {
        "valid": start_sink(
            valid_events(events), f"bronze_valid_{run_id}", paths.bronze, f"{paths.checkpoints}/valid",
            BRONZE_PARTITIONS),
        "quarantine": start_sink(
            quarantined_events(events), f"bronze_quarantine_{run_id}", paths.quarantine,
            f"{paths.checkpoints}/quarantine", QUARANTINE_PARTITIONS),
    }
    seen = {name: {} for name in queries}
    while any([query.isActive for query in queries.values()]):
        for name, query in queries.items():
            query.awaitTermination(POLL_SECONDS)
            seen[name] |= _batches(query)
    for name, query in queries.items():
        query.awaitTermination()
        seen[name] |= _batches(query)
    return {f"{name}_input_rows": sum(batches.values()) for name, batches in seen.items()}


def _batches(query: StreamingQuery) -> dict[int, int]:
    """Input rows of the batches Spark still remembers, which are the last 100;
    read often enough, none is missed."""
    return {p["batchId"]: int(p["numInputRows"]) for p in query.recentProgress}


def read_bronze(spark: SparkSession, paths: BronzePaths) -> DataFrame:
    return read_optional(spark, paths.bronze, BRONZE_SCHEMA)


def read_quarantine(spark: SparkSession, paths: BronzePaths) -> DataFrame:
    return read_optional(spark, paths.quarantine, BRONZE_SCHEMA)


def stream_report(spark: SparkSession, paths: BronzePaths, run_id: str, seconds: float | None = None) -> DataFrame:
    """One row on a stream run: totals of both layers, events this run added,
    duplicate ids, and the rate where the duration is given."""
    bronze, quarantine = read_bronze(spark, paths), read_quarantine(spark, paths)
    mine = F.col("ingestion_run_id") == run_id
    row = one_row(
        bronze.agg(
            F.count("*").alias("bronze_after"), F.count_if(mine).alias("new_bronze_events"),
            F.countDistinct("source_table").alias("source_tables")),
        quarantine.agg(F.count("*").alias("quarantine_after"), F.count_if(mine).alias("new_quarantine_events")),
        duplicate_count(bronze).select(F.col("duplicate_count").alias("duplicate_event_ids")),
    ).withColumns({
        "bronze_before": F.col("bronze_after") - F.col("new_bronze_events"),
        "quarantine_before": F.col("quarantine_after") - F.col("new_quarantine_events"),
    })
    if seconds is None:
        return row
    rate = F.col("new_bronze_events") / F.lit(seconds) if seconds > 0 else F.lit(0.0)
    return row.withColumns({"duration_seconds": F.lit(round(seconds, 3)), "new_events_per_second": F.round(rate, 2)})
