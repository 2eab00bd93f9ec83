"""Order-dependent values per group, computed in blocks.

A window over (topic, partition) would put one whole partition of the log into
one task. Here every group is cut into blocks of consecutive order values: the
window runs inside a block, and what a block needs from earlier blocks is
carried over from one summary row per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OFFSETS_PER_BLOCK = 65_536


def offset_block(offset: str, size: int = OFFSETS_PER_BLOCK) -> Column:
    return F.floor(F.col(offset) / F.lit(size))


def _with_carry(rows: DataFrame, keys: list[str], summary: DataFrame, carried: Column) -> DataFrame:
    carry = summary.select(*keys, "_block", carried.alias("_carried"))
    return rows.join(carry, [*keys, "_block"], "left")


def with_previous(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, block: Column, name: str, descending: bool = False
) -> DataFrame:
    """``lag(value)`` over (keys, order), or ``lead`` when ``descending``.

    ``block`` must be monotone in ``order``. Keys must not be NULL, and
    ``order`` must be unique within a key.
    """
    keys = list(keys)
    blocked = rows.withColumn("_block", block)
    edge = F.min_by if descending else F.max_by
    summary = blocked.groupBy(*keys, "_block").agg(edge(value, order).alias("_edge"))
    sort = (lambda c: F.col(c).desc()) if descending else F.col
    carried = F.lag("_edge").over(Window.partitionBy(*keys).orderBy(sort("_block")))
    inside = Window.partitionBy(*keys, "_block").orderBy(sort(order))
    joined = _with_carry(blocked, keys, summary, carried)
    return joined.withColumn(
        name,
        F.when(F.row_number().over(inside) == 1, F.col("_carried")).otherwise(F.lag(value).over(inside)),
    ).drop("_block", "_carried")


def with_running_max(
    rows: DataFrame, keys: Sequence[str], order: str, value: str, block: Column, name: str
) -> DataFrame:
    """Largest ``value`` of all rows before this one in its group."""
    keys = list(keys)
    blocked = rows.withColumn("_block", block)
    summary = blocked.groupBy(*keys, "_block").agg(F.max(value).alias("_peak"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = _with_carry(blocked, keys, summary, F.max("_peak").over(earlier))
    return joined.withColumn(name, F.greatest("_carried", F.max(value).over(inside))).drop("_block", "_carried")


def with_last(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: Column, name: str) -> DataFrame:
    """The last ``value`` that is not NULL of all rows up to and with this one in its group, by ``order``."""
    keys = list(keys)
    blocked = rows.withColumn("_block", block)
    place = F.when(F.col(value).isNotNull(), F.struct(*order))
    summary = blocked.groupBy(*keys, "_block").agg(F.max_by(value, place).alias("_edge"))
    earlier = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    joined = _with_carry(blocked, keys, summary, F.last("_edge", ignorenulls=True).over(earlier))
    return joined.withColumn(
        name, F.coalesce(F.last(value, ignorenulls=True).over(inside), F.col("_carried"))).drop("_block", "_carried")
