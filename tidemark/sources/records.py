"""Change records from Kafka or from files of the same shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import RECORD_SCHEMA, TABLES

# Rate limit of one micro-batch.
MAX_OFFSETS_PER_TRIGGER = 100_000


def topics(prefix: str, tables: Sequence[str] = TABLES) -> list[str]:
    return [f"{prefix}.{table}" for table in tables]


def kafka_options(servers: str, subscribed: Sequence[str], max_offsets: int = MAX_OFFSETS_PER_TRIGGER) -> dict:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(subscribed),
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
        "maxOffsetsPerTrigger": str(max_offsets),
    }


def kafka_stream(spark: SparkSession, servers: str, subscribed: Sequence[str], **options) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(servers, subscribed, **options)).load()


def kafka_batch(spark: SparkSession, servers: str, subscribed: Sequence[str]) -> DataFrame:
    """Everything from the earliest to the latest offset."""
    chosen = kafka_options(servers, subscribed)
    chosen.pop("maxOffsetsPerTrigger")
    return spark.read.format("kafka").options(**chosen, endingOffsets="latest").load()


def file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same records as Parquet files that appear in a folder."""
    reader = spark.readStream.schema(RECORD_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def file_batch(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD_SCHEMA).parquet(path)


def topic_summary(records: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Per expected or observed topic: records, partitions, and whether it is
    missing. Counted in one pass over (topic, partition)."""
    spark = records.sparkSession
    seen = records.groupBy("topic", "partition").agg(F.count("*").alias("n"))
    per_topic = seen.groupBy("topic").agg(F.sum("n").alias("records"), F.count("*").alias("partitions"))
    wanted = spark.createDataFrame([(t,) for t in expected], "topic string").withColumn("expected", F.lit(True))
    return wanted.join(per_topic, "topic", "full_outer").select(
        "topic",
        F.coalesce("records", F.lit(0)).alias("records"),
        F.coalesce("partitions", F.lit(0)).alias("partitions"),
        F.coalesce("expected", F.lit(False)).alias("expected"),
        F.col("records").isNull().alias("missing"),
    )
