"""Type-2 history: merging a current state into the open versions of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import version_id

# Columns a history table keeps behind the tracked ones.
HISTORY_TAIL = ("scd_id", "valid_from", "valid_to", "is_deleted")


def merge_versions(
    open_versions: DataFrame, current: DataFrame, snapshot_at: Column, key: str, updated_at: str = "updated_at"
) -> DataFrame:
    """One merge step on the open versions (``valid_to`` NULL) of a history.

    One full outer join on the key, so one shuffle of either side; every key
    has at most one row on each. Rows that come back with ``valid_to`` set are
    closed for good, the others are the new open versions:

    * new key: a live version from ``updated_at``
    * live, current row updated since the version's own ``updated_at`` (or
      without one, and different): closed, and a new version from the new
      ``updated_at``, but not before the version began
    * live, key gone: closed at ``snapshot_at``, a copy flagged deleted from there
    * flagged deleted, key back: both at the later of ``updated_at`` and the
      flag's start, so versions never overlap
    * anything else: unchanged

    A row without ``updated_at`` counts as updated at ``snapshot_at``. A live
    version that would end where it began is replaced, not closed.
    """
    columns = current.columns
    old, new = open_versions.alias("o"), current.alias("c")
    joined = old.join(new, F.col(f"o.{key}") == F.col(f"c.{key}"), "full_outer")

    forever, live, dead = F.lit(None).cast("timestamp"), F.lit(False), F.lit(True)
    moved = F.coalesce(F.col(f"c.{updated_at}"), snapshot_at)
    begun, gone = F.col("o.valid_from"), F.col("o.is_deleted")
    returned = F.greatest(moved, begun)

    before = F.struct(*[f"o.{name}" for name in columns])
    after = F.struct(*[f"c.{name}" for name in columns])

    def version(image: Column, start: Column, end: Column, deleted: Column) -> Column:
        return F.struct(
            image.alias("image"), start.alias("valid_from"), end.alias("valid_to"), deleted.alias("is_deleted"))

    def kept(end: Column) -> Column:
        return version(before, begun, end, gone)

    def fresh(start: Column) -> Column:
        return version(after, start, forever, live)

    stamp = F.col(f"c.{updated_at}")
    newer = F.coalesce(F.col(f"o.{updated_at}") < stamp, stamp.isNotNull() & F.col(f"o.{updated_at}").isNull(), F.lit(False))
    newer = newer | (stamp.isNull() & ~before.eqNullSafe(after))
    had, has = F.col(f"o.{key}").isNotNull(), F.col(f"c.{key}").isNotNull()
    versions = (
        F.when(~had, F.array(fresh(moved)))
        .when(has & gone, F.array(kept(returned), fresh(returned)))
        .when(has & newer & (begun < moved), F.array(kept(returned), fresh(returned)))
        .when(has & newer, F.array(fresh(begun)))
        .when(~has & ~gone, F.array(kept(snapshot_at), version(before, snapshot_at, forever, dead)))
        .otherwise(F.array(kept(forever)))
    )
    rows = joined.select(F.explode(versions).alias("v")).select("v.image.*", "v.valid_from", "v.valid_to", "v.is_deleted")
    # the id follows from the row, so that of a kept version comes out the same
    scd_id = version_id(F.col(key), F.col("valid_from"), F.col("is_deleted")).alias("scd_id")
    return rows.select(*columns, scd_id, "valid_from", "valid_to", "is_deleted")
