"""Profiling aggregates: counts, nulls, percentiles, roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.measures import any_null


def count_by(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("row_count")).orderBy(column)


def distinct_counts(rows: DataFrame, groups: Mapping[str, Sequence[str]]) -> DataFrame:
    """One row with the number of distinct combinations per named column set."""
    singles = [
        rows.select(*columns).distinct().agg(F.count("*").alias(name)) for name, columns in groups.items()
    ]
    return one_row(*singles)


def null_counts(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs per column, in one pass."""
    return rows.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def conditional_counts(rows: DataFrame, conditions: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows per named condition, in one pass."""
    return rows.agg(*[F.count_if(condition).alias(name) for name, condition in conditions.items()])


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    return reduce(DataFrame.unionByName, [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ])


def one_row(*rows: DataFrame) -> DataFrame:
    """Puts one-row frames side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def connector_latency(events: DataFrame) -> DataFrame:
    """Latency of live changes; snapshot reads and negative values left out."""
    spread = F.col("connector_timestamp_ms") - F.col("source_timestamp_ms")
    return events.filter(F.col("operation").isin("c", "u", "d")).select(spread.alias("latency_ms")).filter(
        F.col("latency_ms") >= 0)


def approximate_percentiles(latency: DataFrame, accuracy: int = 100_000) -> DataFrame:
    """Median, 95th percentile and maximum in one pass with bounded state.

    Values seen, not interpolated ones; off by less than a rank in
    ``accuracy``, and exact up to as many distinct milliseconds.
    """
    return latency.agg(
        F.count("*").alias("measured_events"),
        F.percentile_approx("latency_ms", 0.5, accuracy).cast("double").alias("median_ms"),
        F.percentile_approx("latency_ms", 0.95, accuracy).cast("double").alias("p95_ms"),
        F.max("latency_ms").cast("double").alias("maximum_ms"),
    )


def exact_percentiles(latency: DataFrame) -> DataFrame:
    """Interpolated percentiles. Equal values are counted first, so the final
    step sees one row per distinct millisecond, not per event."""
    histogram = latency.groupBy("latency_ms").agg(F.count("*").alias("n"))
    return histogram.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("measured_events"),
        F.percentile("latency_ms", 0.5, F.col("n")).alias("median_ms"),
        F.percentile("latency_ms", 0.95, F.col("n")).alias("p95_ms"),
        F.max("latency_ms").cast("double").alias("maximum_ms"),
    )


def fingerprint(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Row count and an order-independent content hash: the sums of both halves
    of a 128-bit hash of every row's text. Equal rows add up, so a duplicate
    changes it."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in columns])

    def half(start: int) -> Column:
        piece = F.conv(F.substring(F.md5(text), start, 16), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(piece), F.lit(0)).cast("decimal(38,0)")

    return rows.agg(
        F.count("*").alias("row_count"), half(1).alias("content_sum"), half(17).alias("content_sum_low"))
