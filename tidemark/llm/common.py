"""What several operators share: reading a table, stored tables, broadcast arrays, one-row-per-text passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.lake import drop_stored, stored

UPPER, LOWER_CASE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(text, UPPER, LOWER_CASE)


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of an id as text, modulo; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("null")).cast("binary")) % modulus


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, longer if ``frame`` has a column of that name."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_batches(frame: DataFrame, work: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on every Arrow batch of ``frame``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from work(batch)

    return frame.mapInArrow(run, schema)


__all__ = ["LOWER_CASE", "UPPER", "crc_mod", "drop_stored", "free_name", "lower_ascii", "map_batches", "read", "stored"]
