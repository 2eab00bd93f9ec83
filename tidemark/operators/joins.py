"""Joins that keep working when a few keys hold much of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by key in as many partitions as shuffles have, which stay as they are.

    Adaptive execution puts partitions together until a task a core or 64 MB of
    compressed rows are left. A hash table of nearly as many groups as rows is a
    multiple of that.
    """
    number = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(number, *keys)


def lookup(left: DataFrame, right: DataFrame, key: str, condition: Column | None = None, how: str = "left") -> DataFrame:
    """Join ``left`` (``l``) to ``right`` (``r``) on ``key``, plus ``condition``; columns of ``left`` first.

    Spark broadcasts the right side where it is small; otherwise adaptive
    execution splits the partitions of heavy keys and of NULL, whatever their
    number.
    """
    a, b = left.alias("l"), right.alias("r")
    on = F.col(f"l.{key}") == F.col(f"r.{key}")
    joined = a.join(b, on if condition is None else on & condition, how)
    kept = [F.col(f"l.{name}") for name in left.columns]
    added = [F.col(f"r.{name}") for name in right.columns if name not in left.columns]
    return joined.select(*kept, *added)


def missing_keys(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of child rows.

    Children are counted per key before the join, so a hot key travels as one
    row per map task. NULL child keys are not counted.
    """
    counted = child.filter(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("missing_key")).agg(
        F.count("*").alias("row_count"))
    parents = parent.select(F.col(parent_key).alias("missing_key"))
    return counted.join(parents, "missing_key", "left_anti")
