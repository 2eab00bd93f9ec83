"""Tables of immutable versions, published together.

A table is written in parts. A version names, for each part, the folder that
holds it, so a change writes the parts it touches and nothing else, and old
versions stay readable. What is newest is decided in one place: a commit of the
publication names the version of every table, so readers see all tables of one
build or all tables of the one before. A build that dies leaves folders no commit
names, which the next build overwrites.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.current import latest_per_key
from tidemark.session import shuffles_dropped
from tidemark.sources.files import children, read_text, remove, write_text
from tidemark.sources.lake import drop_stored, stored

PART = "_part"
# a column of an event made of others, which are asked for by name
Derived = Callable[[Callable[[str], Column]], Column]


class VersionedTable:
    """One table below ``path``: ``data/version=N/_part=P`` and ``manifests/N.json``.

    A manifest holds the columns and the folder of every part; a part written
    before a column was added reads as NULL there. Manifests are as large as a
    table has parts and are read and written without a job.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def manifest(self, version: int | None) -> tuple[dict[str, int], T.StructType | None]:
        """The folder of every part, and the columns."""
        if version is None:
            return {}, None
        told = json.loads(read_text(self.spark, f"{self.path}/manifests/{version}.json"))
        return told["parts"], T.StructType.fromJson(told["columns"])

    def read(self, version: int, parts: Iterable[str] | None = None) -> DataFrame:
        """The table at a version, or some of its parts."""
        return self.read_parts(version, parts).drop(PART)

    def read_parts(self, version: int, parts: Iterable[str] | None = None, hidden: Iterable[T.StructField] = ()) -> DataFrame:
        """As ``read``, with the part of every row and the ``hidden`` columns asked for."""
        folders, columns = self.manifest(version)
        wanted = sorted(folders if parts is None else set(parts) & folders.keys())
        layout = T.StructType([*columns.fields, *hidden, T.StructField(PART, T.StringType())])
        if not wanted:
            return self.spark.createDataFrame([], layout)
        paths = [f"{self.path}/data/version={folders[part]}/{PART}={part}" for part in wanted]
        found = self.spark.read.schema(layout).option("basePath", f"{self.path}/data").parquet(*paths)
        return found.select(*layout.fieldNames())

    def write(self, version: int, rows: DataFrame | Iterable[DataFrame], part: Column, base: int | None = None, touched: Iterable[str] = (),
              gathered: bool = True, hidden: Iterable[str] = ()) -> int:
        """Version ``version``: the parts of ``base`` without ``touched``, and ``rows``, which lie in touched or new parts.

        A large part is written by several tasks, small ones share one. Without ``gathered``, for tables of few parts,
        every task writes the rows it has and nothing is shuffled. ``hidden`` columns are written but are none of the table's.
        Several frames of ``rows`` are written one after the other, each with its own shuffles.
        """
        kept, _ = self.manifest(base)
        folder = f"{self.path}/data/version={version}"
        for number, some in enumerate([rows] if isinstance(rows, DataFrame) else rows):
            placed = some.select(*[c for c in some.columns if c != PART], part.cast("string").alias(PART))
            columns = T.StructType([f for f in placed.schema.fields if f.name not in {PART, *hidden}])
            if gathered:
                placed = placed.hint("rebalance", PART)
            with shuffles_dropped(self.spark):
                (placed.write.mode("append" if number else "overwrite").option("partitionOverwriteMode", "static")
                 .option("compression", "zstd").partitionBy(PART).parquet(folder))
        written = [name.removeprefix(f"{PART}=") for name in children(self.spark, folder) if name.startswith(f"{PART}=")]
        gone = set(touched)
        live = {p: f for p, f in kept.items() if p not in gone} | {part: version for part in written}
        told = {"columns": json.loads(columns.json()), "parts": dict(sorted(live.items()))}
        write_text(self.spark, f"{self.path}/manifests/{version}.json", json.dumps(told))
        return version

    def replace_keys(self, base: int | None, version: int, rows: DataFrame, keys: DataFrame, key: str, part: Column) -> int:
        """Rows of the keys in ``keys`` go, ``rows`` come; only parts that lose or gain a row are rewritten.

        Where the old rows lie is found by their key column alone.
        """
        if base is None:
            return self.write(version, rows, part)
        new = stored(rows.withColumn(PART, part.cast("string")), "replacing", "zstd")
        gone = keys.select(F.col(key).alias("_gone"))
        # a null key is a key like any other
        same = F.col(key).eqNullSafe(F.col("_gone"))
        hit = self.read_parts(base).select(key, PART).join(gone, same, "left_semi").select(PART)
        touched = [row[PART] for row in hit.union(new.select(PART)).distinct().collect()]
        if touched:
            old = self.read_parts(base, touched).join(gone, same, "left_anti")
            self.write(version, new.unionByName(old, allowMissingColumns=True), F.col(PART), base, touched)
        drop_stored(new)
        return version if touched else base

    def expire(self, keep: Iterable[int], known: Iterable[int]) -> int:
        """Drops the folders and manifests of the ``known`` versions that no version in ``keep`` needs."""
        keep = set(keep)
        live = {place for version in keep for place in self.manifest(version)[0].items()}
        dropped = 0
        for version in sorted(set(known) - keep):
            for place in self.manifest(version)[0].items():
                if place not in live:
                    remove(self.spark, f"{self.path}/data/version={place[1]}/{PART}={place[0]}")
                    live.add(place)
                    dropped += 1
            remove(self.spark, f"{self.path}/manifests/{version}.json")
        return dropped


class Publication:
    """The commit log of builds: each names the version of every table at once.

    A commit is one file that is moved into place, so it is there as a whole or
    not at all.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def builds(self) -> list[int]:
        names = [name.removesuffix(".json") for name in children(self.spark, self.path) if name.endswith(".json")]
        return sorted(int(name) for name in names)

    def last(self) -> int | None:
        return max(self.builds(), default=None)

    def tables(self, build: int | None = None) -> dict[str, tuple[int, str | None]]:
        """Version and note of every table at a build, the newest one if none is given."""
        known = [b for b in self.builds() if build is None or b <= build]
        if not known:
            return {}
        told = json.loads(read_text(self.spark, f"{self.path}/{known[-1]}.json"))
        return {name: (version, note) for name, (version, note) in told.items()}

    def commit(self, build: int, tables: Mapping[str, tuple[int, str | None]]) -> None:
        write_text(self.spark, f"{self.path}/{build}.json", json.dumps(dict(sorted(tables.items()))))

    def expire(self, tables: Mapping[str, VersionedTable], keep: int) -> int:
        """Drops what only builds before the last ``keep`` needed, and their commits; returns the number of folders.
        Readers pinned to one of those builds lose it."""
        builds = self.builds()
        old, kept = builds[:-keep], builds[-keep:]
        versions = {build: self.tables(build) for build in builds}
        dropped = 0
        for name, table in tables.items():
            wanted = {versions[b][name][0] for b in kept if name in versions[b]}
            dropped += table.expire(wanted, {versions[b][name][0] for b in old if name in versions[b]} - wanted)
        for build in old:
            remove(self.spark, f"{self.path}/{build}.json")
        return dropped


class StateTable:
    """The newest event of every key, deletes included, in parts by a hash of the key.

    A merge reads and rewrites the parts its batch touches. Events keep the columns
    they are ordered by, so an event that arrives after a newer one of its key changes
    nothing, in whatever order batches come.

    Rows whose key is surely not in the batch, by a bitmap of hashed keys, are copied
    where they are; the others meet the batch in one join. A large batch is merged some
    parts at a time, so that its bitmaps stay sparse and only what those parts shuffle
    is on disk. A rewritten row remembers which event it replaced, so what a merge changed
    is read from the version itself.

    Columns that follow from others of an event may be ``derived``: they are worked out
    whenever events are read, and never stored or shuffled.
    """

    def __init__(self, table: VersionedTable, key: str, parts: int, derived: Mapping[str, Derived] | None = None):
        self.table, self.key, self.parts, self.derived = table, key, parts, dict(derived or {})

    def part(self) -> Column:
        return F.concat(F.lit("h"), F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("string"))

    def read(self, version: int | None) -> DataFrame:
        return self.whole(self.table.read(version))

    def whole(self, rows: DataFrame) -> DataFrame:
        return rows.withColumns({name: made(F.col) for name, made in self.derived.items()})

    def whole_event(self, event: str) -> Column:
        found = F.col(event)
        for name, made in self.derived.items():
            found = found.withField(name, made(lambda c: F.col(f"{event}.{c}")))
        return found.alias(event)

    def merge(self, base: int | None, version: int, batch: DataFrame) -> tuple[int, DataFrame | None]:
        """Merges a batch of events; returns the new version and the changes: ``old`` and ``new`` event of every key whose
        newest event is another one now. A first batch changes everything, and no table says so."""
        batch = self.whole(batch)
        if base is None:
            best, scratch = newest_of(batch, self.key)
            self.table.write(version, best.drop(*self.derived), self.part(), gathered=False)
            drop_stored(*scratch)
            return version, None
        best = latest_per_key(batch, [self.key]).drop(*self.derived)
        newest = stored(best.withColumn(PART, self.part()), "state_batch", "zstd", PART)
        names = [c for c in newest.columns if c != PART]
        keys = {row[PART]: row["count"] for row in newest.groupBy(PART).count().collect()}
        touched = sorted(keys)
        merged = self._merged(base, newest, together(keys, KEYS_AT_ONCE))
        self.table.write(version, merged, F.col(PART), base, touched, gathered=False, hidden=(_CHANGED, _OLD))
        drop_stored(newest)
        event = T.StructType([newest.schema[c] for c in names])
        written = self.table.read_parts(version, touched, [T.StructField(_CHANGED, T.BooleanType()), T.StructField(_OLD, event)])
        changes = written.filter(_CHANGED).select(F.col(_OLD).alias("old"), F.struct(*names).alias("new"))
        return version, changes.select(self.whole_event("old"), self.whole_event("new"))

    def _merged(self, base: int, newest: DataFrame, groups: Iterable[list[str]]) -> Iterator[DataFrame]:
        """The rows of each group of parts; what one needs is dropped when the next is asked for."""
        image = F.struct(*newest.columns)
        for parts in groups:
            mine = newest.filter(F.col(PART).isin(parts))
            bits = stored(key_bits(mine, self.key), "state_bits")
            old = maybe_among(self.table.read_parts(base, parts).select(*newest.columns), self.key, bits)
            # a null key is a key like any other
            met = old.filter(_MAYBE).select(image.alias("old")).join(
                mine.select(image.alias("new")), F.col(f"old.{self.key}").eqNullSafe(F.col(f"new.{self.key}")), "full_outer")
            both = met.select(self.whole_event("old"), self.whole_event("new"))
            newer = F.col("new").isNotNull() & (F.col("old").isNull() | (change_order("new") > change_order("old")))
            changed = newer & (F.col("old").isNull() | (F.col("old.event_id") != F.col("new.event_id")))
            rows = both.select(F.when(newer, F.col("new")).otherwise(F.col("old")).alias("row"), changed.alias(_CHANGED),
                               F.when(changed, F.col("old").dropFields(PART, *self.derived)).alias(_OLD))
            rows = rows.select("row.*", _CHANGED, _OLD).drop(*self.derived)
            yield rows.unionByName(old.filter(~F.col(_MAYBE)).drop(_MAYBE), allowMissingColumns=True)
            drop_stored(bits)


_MAYBE, _CHANGED, _OLD = "_maybe", "_changed", "_old"
# half of what Spark broadcasts by itself; a fuller bitmap lets more rows through to the join
KEY_BITS = 1 << 25
# an eighth of the bits
KEYS_AT_ONCE = KEY_BITS >> 3


def together(sizes: Mapping[str, int], most: int) -> list[list[str]]:
    """Names in groups of at most ``most`` together, or of one name; one empty group where there are none."""
    groups: list[list[str]] = [[]]
    room = most
    for name, size in sorted(sizes.items()):
        if groups[-1] and size > room:
            groups.append([])
            room = most
        groups[-1].append(name)
        room -= size
    return groups


def newest_of(batch: DataFrame, key: str) -> tuple[DataFrame, list[DataFrame]]:
    """The newest event of every key, and the tables to drop once it is written. Of rows that are surely alone of their
    key nothing but the key is shuffled."""
    several = stored(batch.groupBy(key).agg(F.count("*").alias("_rows")).filter("_rows > 1").select(key), "state_several")
    if several.isEmpty():
        return batch, [several]
    bits = stored(key_bits(several, key), "state_bits")
    judged = maybe_among(batch, key, bits)
    best = latest_per_key(judged.filter(_MAYBE).drop(_MAYBE), [key])
    return best.unionByName(judged.filter(~F.col(_MAYBE)).drop(_MAYBE)), [several, bits]


def change_order(event: str) -> Column:
    """What ``newest_first`` sorts by, as one value that is largest for the newest event."""
    return F.struct(*[F.col(f"{event}.{c}") for c in ("source_timestamp_ms", "kafka_timestamp", "kafka_offset", "event_id")])


def _bit_of(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(KEY_BITS))


def key_bits(rows: DataFrame, key: str) -> DataFrame:
    """Bitmap of hashed keys, in pieces of four kilobytes."""
    bit = _bit_of(key)
    return rows.groupBy(F.bitmap_bucket_number(bit).alias("_piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bits"))


def maybe_among(rows: DataFrame, key: str, bits: DataFrame) -> DataFrame:
    """``rows`` with ``_maybe``: false where the key is surely not one of those in ``bits``."""
    at = F.bitmap_bit_position(_bit_of(key))
    byte = F.conv(F.hex(F.substring(F.col("_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    joined = rows.join(bits, F.bitmap_bucket_number(_bit_of(key)) == F.col("_piece"), "left")
    return joined.withColumn(_MAYBE, F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).select(*rows.columns, _MAYBE)
