"""Lateness of events while they stream, against the newest event before them in their topic partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ordered import OFFSETS_PER_BLOCK, offset_block, with_running_max
from tidemark.operators.policy import ALLOWED_LATENESS_SECONDS, order_class
from tidemark.sources.files import remove
from tidemark.sources.lake import drop_stored, read_optional, stored

PARTITION = ["kafka_topic", "kafka_partition"]
_HIGH = T.StructType([
    T.StructField("kafka_topic", T.StringType()), T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("high", T.LongType())])


def classified(events: DataFrame, high: DataFrame, time: str, allowed_seconds: float, block_size: int) -> DataFrame:
    """A batch's events with their classes, ``high`` being the newest times of all batches before."""
    marked = with_running_max(
        events, PARTITION, "kafka_offset", time, offset_block("kafka_offset", block_size), "_inside")
    known = high.select(*[F.col(c).alias(f"_{c}") for c in PARTITION], "high")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PARTITION]
    joined = marked.join(known, same[0] & same[1], "left").withColumn("_watermark", F.greatest("_inside", "high"))
    return joined.withColumns(order_class(
        F.timestamp_millis(time), F.timestamp_millis("_watermark"), allowed_seconds)).select(
            *events.columns, "order_status", "event_delay_seconds", "is_out_of_order", "is_late", "requires_backfill")


def start_order_stream(
    events: DataFrame, path: str, checkpoint: str, time: str = "source_timestamp_ms",
    allowed_seconds: float = ALLOWED_LATENESS_SECONDS, block_size: int = OFFSETS_PER_BLOCK,
) -> StreamingQuery:
    """Classifies everything available now, micro-batch by micro-batch, below ``path``.

    The state is one row a topic partition, the newest time of all batches so
    far, written beside the classes of every batch. Both are folders named by the
    number of the batch, so a batch that is run again after a restart begins from
    the same state and replaces what it wrote. Inside a batch a busy partition is
    cut into blocks of offsets, as in the batch form, instead of being one task's
    state. A topic partition has to arrive in the order of its offsets, as it does
    from its log.
    """
    def batch(frame: DataFrame, number: int) -> None:
        rows = stored(frame, "order_batch")
        high = read_optional(frame.sparkSession, f"{path}/high/batch={number - 1}", _HIGH)
        classified(rows, high, time, allowed_seconds, block_size).write.mode("overwrite").parquet(f"{path}/classes/batch={number}")
        now = rows.groupBy(*PARTITION).agg(F.max(time).alias("high")).select(*[F.col(f.name).cast(f.dataType) for f in _HIGH.fields])
        both = now.unionByName(high).groupBy(*PARTITION).agg(F.max("high").alias("high"))
        both.write.mode("overwrite").parquet(f"{path}/high/batch={number}")
        drop_stored(rows)
        # the one before may be needed to run this batch again
        remove(frame.sparkSession, f"{path}/high/batch={number - 2}")

    return (events.writeStream.queryName("event_order").foreachBatch(batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
