"""A Parquet lake: layers, optional reads, appends, keyed replacement and
versioned history tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.current import live_rows
from tidemark.operators.scd2 import HISTORY_TAIL, merge_versions
from tidemark.session import scratch_path, shuffles_dropped
from tidemark.sources.files import remove

# Which folder holds the tables of a layer, and which layers stay views.
LAYER_FOLDERS = {
    "bronze": "landing/bronze",
    "quarantine": "quarantine/bronze",
    "raw": "raw",
    "staging": "staging",
    "snapshots": "snapshots",
    "marts": "analytics",
    "audit": "audit",
}


def require_columns(frame: DataFrame, required: Iterable[str], what: str = "bronze data") -> DataFrame:
    """Contract check on the schema; runs no job."""
    missing = sorted(set(required) - set(frame.columns))
    if missing:
        raise ValueError(f"{what} is missing required columns: {', '.join(missing)}")
    return frame


def read_optional(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet at ``path``, or no rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def existing(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or ``None`` where there is none yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


class Lake:
    """Tables below one root folder of a shared file system."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, table: str | None = None) -> str:
        folder = f"{self.root}/{LAYER_FOLDERS[layer]}"
        return f"{folder}/{table}" if table else folder

    def read(self, layer: str, table: str | None = None) -> DataFrame:
        """A table; one that builds publish as the newest published build left it."""
        if table and layer in ("snapshots", "marts"):
            state = table.replace("current_", "state_")
            known = self.publication().tables()
            if state in known:
                found = self.versioned(state).read(known[state][0])
                return live_rows(found, table.removeprefix("current_")) if state != table else found
        return self.spark.read.parquet(self.path(layer, table))

    def publication(self) -> "Publication":
        from tidemark.sources.versions import Publication

        return Publication(self.spark, f"{self.root}/published")

    def versioned(self, table: str) -> "VersionedTable":
        from tidemark.sources.versions import VersionedTable

        return VersionedTable(self.spark, f"{self.root}/versions/{table}")

    def read_optional(self, layer: str, table: str | None, schema: T.StructType) -> DataFrame:
        return read_optional(self.spark, self.path(layer, table), schema)

    def append(self, frame: DataFrame, layer: str, table: str | None = None, partition_by: tuple[str, ...] = ()):
        with shuffles_dropped(self.spark):
            frame.write.mode("append").partitionBy(*partition_by).parquet(self.path(layer, table), compression="zstd")

    def overwrite(self, frame: DataFrame, layer: str, table: str) -> DataFrame:
        frame.write.mode("overwrite").parquet(self.path(layer, table))
        return self.read(layer, table)

    def replace_by_key(
        self, frame: DataFrame, layer: str, table: str, key: str, bucket: str, bucket_of: Column
    ) -> DataFrame:
        """Delete and insert by ``key``: only keys present in ``frame`` are
        replaced, all other rows stay.

        The table is partitioned by a coarser ``bucket`` of the key, and only
        buckets ``frame`` touches are rewritten. Spark stages them and swaps
        them in at job commit, so they may be read while they are replaced.
        Where the columns changed, the whole table takes the new set: added
        columns are NULL in old rows, removed ones go.
        """
        path = self.path(layer, table)
        # used three times below
        new = stored(frame.withColumn(bucket, bucket_of), table)
        old = existing(self.spark, path)
        if old is None:
            rows = new
        elif set(old.columns) == set(new.columns):
            touched = old.join(new.select(bucket).distinct(), bucket, "left_semi")
            rows = replace_rows(touched, new, key)
        else:
            # every bucket has rows here, so all of them are swapped
            rows = sync_columns(replace_rows(old, new, key), new.schema)
        (rows.repartition(F.col(bucket)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(bucket).parquet(path))
        return self.spark.read.parquet(path)

    def history(self, table: str, schema: T.StructType, key: str) -> "HistoryTable":
        return HistoryTable(self.spark, self.path("snapshots", table), schema, key)


def replace_rows(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Old rows whose key is absent from ``new``, and all new rows."""
    keys = new.select(key).distinct()
    return old.join(keys, key, "left_anti").unionByName(new, allowMissingColumns=True)


def sync_columns(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones NULL, surplus dropped."""
    return frame.select(*[
        (F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


class HistoryTable:
    """A Type-2 history on immutable Parquet.

    Every merge writes one folder ``merge_id=N`` holding the versions it closed
    and all versions open afterwards, then one row to the commit log. A reader
    takes the closed versions of every committed merge and the open versions of
    the last, both by partition pruning. Closed history is never rewritten, and
    a merge that dies half-way leaves a folder no commit names, which the next
    run overwrites.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        self.spark, self.path, self.key = spark, path, key
        self.tracked = schema
        self.schema = T.StructType(
            schema.fields
            + [T.StructField("scd_id", T.StringType()), T.StructField("valid_from", T.TimestampType()),
               T.StructField("valid_to", T.TimestampType()), T.StructField("is_deleted", T.BooleanType())])

    _COMMITS = T.StructType([T.StructField("committed_merge", T.LongType())])

    def last_merge(self) -> int:
        log = read_optional(self.spark, f"{self.path}/commits", self._COMMITS)
        last = log.agg(F.max("committed_merge").alias("n")).first()["n"]
        return 0 if last is None else last

    def _stored(self) -> DataFrame:
        layout = T.StructType(
            self.schema.fields
            + [T.StructField("merge_id", T.LongType()), T.StructField("is_open", T.BooleanType())])
        return read_optional(self.spark, f"{self.path}/versions", layout)

    def _committed(self, last: int, closed: bool) -> DataFrame:
        kept = (F.col("merge_id") == last) & F.col("is_open")
        if closed:
            kept = kept | ((F.col("merge_id") <= last) & ~F.col("is_open"))
        return self._stored().filter(kept).select(*self.schema.fieldNames())

    def open_versions(self) -> DataFrame:
        return self._committed(self.last_merge(), closed=False)

    def read(self) -> DataFrame:
        return self._committed(self.last_merge(), closed=True)

    def read_at(self, merge: int) -> DataFrame:
        """The history as it was after a merge."""
        return self._committed(merge, closed=True)

    def merge(
        self, current: DataFrame, snapshot_at: Column, updated_at: str = "updated_at", base: int | None = None
    ) -> int:
        """Merges a current state; returns the number of the merge. With ``base``, what was merged after that merge is
        replaced: a build that did not come to its end."""
        last = self.last_merge() if base is None else base
        tracked = current.select(*self.tracked.fieldNames())
        versions = merge_versions(
            self._committed(last, closed=False), tracked, snapshot_at, self.key, updated_at)
        with shuffles_dropped(self.spark):
            (versions.withColumn("is_open", F.col("valid_to").isNull())
             .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("is_open")
             .parquet(f"{self.path}/versions/merge_id={last + 1}"))
        (self.spark.range(0, 1, 1, 1).select(F.lit(last + 1).cast("long").alias("committed_merge"))
         .write.mode("append").parquet(f"{self.path}/commits"))
        return last + 1


def stored(frame: DataFrame, name: str, compression: str | None = None, parts: str | None = None) -> DataFrame:
    """``frame`` as a table in the shared scratch folder. Cuts lineage, and what
    is used several times is computed once and survives its executors. Rows of
    one value of ``parts``, the last column, lie in a folder of their own."""
    path = scratch_path(frame.sparkSession, name)
    with shuffles_dropped(frame.sparkSession):
        frame.write.parquet(path, partitionBy=parts, compression=compression)
    table = frame.sparkSession.read.schema(frame.schema).parquet(path)
    table.scratch = path
    return table


def drop_stored(*tables: DataFrame) -> None:
    """Deletes tables that ``stored`` made, once nothing reads them any more."""
    for table in tables:
        remove(table.sparkSession, table.scratch)


def drop_part(table: DataFrame, part: str, value) -> None:
    """Deletes the rows of one value of the column that ``stored`` was given as ``parts``."""
    remove(table.sparkSession, f"{table.scratch}/{part}={value}")


__all__ = [
    "HISTORY_TAIL", "HistoryTable", "Lake", "drop_part", "drop_stored", "existing", "read_optional", "remove", "replace_rows",
    "require_columns", "stored", "sync_columns",
]
