"""As-of join by interleaving: versions and rows in one order of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ordered import with_last

FOREVER = "9999-12-31 00:00:00"


def as_of(
    rows: DataFrame, versions: DataFrame, key: str, at: str, columns: Sequence[str], valid_from: str = "valid_from",
    valid_to: str = "valid_to", block: Column | None = None,
) -> DataFrame:
    """``rows`` with ``columns`` of the version of their key that was valid at their time, NULL where none was.

    A join on the key with a range compares every row of a key with all its
    versions. Here both are sorted together by key and time and the last version
    that has begun is carried forward, so the work is that of a sort, however
    many versions and rows a key has. The key and ``block`` (days, unless another
    monotone function of ``_at`` is given) share a task; the last version of a
    block is carried to later ones. Versions of a key must not overlap. Rows
    without key or time have no version.
    """
    timed = F.col(key).isNotNull() & F.col(at).isNotNull()
    image, kind = F.struct(*rows.columns), rows.schema
    version = F.struct(F.col(valid_to).alias("until"), *columns)
    begun = versions.filter(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).select(
        F.col(key).alias("_key"), F.col(valid_from).alias("_at"), F.lit(0).alias("_side"),
        F.coalesce(F.col(valid_to), F.lit(FOREVER).cast("timestamp")).alias("_until"),
        F.lit(None).cast(kind).alias("_row"), version.alias("_version"))
    asked = rows.filter(timed).select(
        F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast("timestamp").alias("_until"),
        image.alias("_row"), F.lit(None).cast(begun.schema["_version"].dataType).alias("_version"))
    day = F.to_date("_at") if block is None else block
    found = with_last(begun.unionByName(asked), ["_key"], ["_at", "_side", "_until"], "_version", day, "_found").filter("_side = 1")
    valid = F.col("_found.until").isNull() | (F.col("_at") < F.col("_found.until"))
    joined = found.select("_row.*", *[F.when(valid, F.col(f"_found.{name}")).alias(name) for name in columns])
    nulls = [F.lit(None).cast(versions.schema[name].dataType).alias(name) for name in columns]
    return joined.unionByName(rows.filter(~timed).select(*rows.columns, *nulls))
