"""What the fourth review found: what merges and builds leave on disk while they run."""

from __future__ import annotations

import random
import time
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.catalog import queries
from tidemark.catalog.queries import QUERIES
from tidemark.operators.current import latest_per_key
from tidemark.plans import refresh
from tidemark.session import shared_root
from tidemark.sources import versions
from tidemark.sources.files import children
from tidemark.sources.lake import drop_stored, stored
from tidemark.sources.versions import StateTable, VersionedTable, newest_of, together

AT = datetime(2024, 1, 1)
EVENTS = "id long, v string, event_id string, is_deleted boolean, source_timestamp_ms long, kafka_timestamp timestamp, kafka_offset long"


def events(draw: random.Random, many: int, keys: int) -> list[tuple]:
    return [(draw.choice([None, *range(keys)]), f"v{n}", f"e{n}", draw.random() < 0.2, draw.randrange(200), AT, n) for n in range(many)]


def shuffle_files(spark) -> int:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def test_a_write_leaves_no_shuffle_files(spark, tmp_path):
    """F1, F2."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    setting, before = spark.conf.get(name, None), shuffle_files(spark)
    rows = spark.range(20_000).withColumn("m", F.col("id") % 3).groupBy("id", "m").count()
    made = stored(rows, "written")
    VersionedTable(spark, f"{tmp_path}/t").write(1, rows, F.col("m"))
    for _ in range(50):
        if shuffle_files(spark) <= before:
            break
        time.sleep(0.2)
    assert shuffle_files(spark) <= before and spark.conf.get(name, None) == setting
    drop_stored(made)


def test_the_newest_events_of_a_first_load_are_those_of_the_rank(spark):
    """rows alone of their key are not shuffled."""
    draw = random.Random(5)
    for rows in (events(draw, 200, 60), [(n, *event[1:]) for n, event in enumerate(events(draw, 50, 9))]):
        batch = spark.createDataFrame(rows, EVENTS)
        best, scratch = newest_of(batch, "id")
        assert sorted(map(str, best.collect())) == sorted(map(str, latest_per_key(batch, ["id"]).collect()))
        drop_stored(*scratch)
    assert "Exchange" not in best._jdf.queryExecution().executedPlan().toString()


def test_a_large_batch_is_merged_some_parts_at_a_time(spark, tmp_path, monkeypatch):
    """F1, F2."""
    assert together({"a": 3, "b": 3, "c": 9, "d": 1}, 6) == [["a", "b"], ["c"], ["d"]] and together({}, 6) == [[]]
    monkeypatch.setattr(versions, "KEYS_AT_ONCE", 5)
    groups = []
    monkeypatch.setattr(versions, "together", lambda *a: groups.append(together(*a)) or groups[-1])
    draw = random.Random(9)
    known = events(draw, 120, 30)
    state = StateTable(VersionedTable(spark, f"{tmp_path}/s"), "id", 6)
    before = set(children(spark, shared_root(spark)))
    state.merge(None, 1, spark.createDataFrame(known[:60], EVENTS))
    version, changes = state.merge(1, 2, spark.createDataFrame(known[60:], EVENTS))
    newest = {r["id"]: r["event_id"] for r in latest_per_key(spark.createDataFrame(known, EVENTS), ["id"]).collect()}
    first = {r["id"]: r["event_id"] for r in state.read(1).collect()}
    assert {r["id"]: r["event_id"] for r in state.read(version).collect()} == newest and state.read(version).count() == len(newest)
    told = {r["new"]["id"]: (r["old"] and r["old"]["event_id"], r["new"]["event_id"]) for r in changes.collect()}
    assert told == {key: (first.get(key), e) for key, e in newest.items() if first.get(key) != e}
    assert len(groups[0]) > 2 and set(children(spark, shared_root(spark))) == before
    # a batch without events
    version, changes = state.merge(2, 3, spark.createDataFrame([], EVENTS))
    assert state.read(version).count() == len(newest) and changes.count() == 0


def test_derived_columns_are_read_but_not_stored(spark, tmp_path):
    """F2."""
    state = StateTable(VersionedTable(spark, f"{tmp_path}/s"), "id", 2, {"event_id": lambda c: F.concat(F.lit("e"), c("kafka_offset"))})
    state.merge(None, 1, spark.createDataFrame([(i, "a", "", False, 1, AT, i) for i in range(9)], EVENTS).drop("event_id"))
    version, changes = state.merge(1, 2, spark.createDataFrame([(i, "b", "", False, 2, AT, i + 50) for i in (3, 70)], EVENTS).drop("event_id"))
    assert "event_id" not in state.table.manifest(version)[1].names
    assert {r["event_id"] for r in state.read(version).collect()} == {"e53", "e120", *(f"e{i}" for i in range(9) if i != 3)}
    assert {(r["old"] and r["old"]["event_id"], r["new"]["event_id"]) for r in changes.collect()} == {("e3", "e53"), (None, "e120")}


def test_the_incremental_state_query_drops_what_is_merged(spark, sf_dir, monkeypatch):
    """each load of the log and each state that is followed by another."""
    merge, left = StateTable.merge, []
    before = set(children(spark, shared_root(spark)))

    def watched(self, *given):
        made = [name for name in set(children(spark, shared_root(spark))) - before if name.startswith("order_items_log")]
        left.append((len(children(spark, f"{self.table.path}/manifests")),
                     [name for name in children(spark, f"{shared_root(spark)}/{made[0]}") if name.startswith("_day=")]))
        return merge(self, *given)

    monkeypatch.setattr(StateTable, "merge", watched)
    QUERIES["current_order_items_incremental"](spark, sf_dir)
    days = ["_day=0", "_day=1", "_day=2", "_day=3"]
    assert left == [(0, days), (1, days[1:]), (1, ["_day=1", "_day=3"]), (1, ["_day=3"])]


def test_the_build_stores_no_records_and_of_raw_rows_what_it_reads(spark, sf_dir, monkeypatch):
    """F1."""
    names, store = [], queries.stored
    monkeypatch.setattr(queries, "stored", lambda frame, name, *more: names.append(name) or store(frame, name, *more))
    before = set(children(spark, shared_root(spark)))
    QUERIES["incremental_build"](spark, sf_dir)
    lake = next(name for name in set(children(spark, shared_root(spark))) - before if name.startswith("lake-"))
    raw = spark.read.parquet(f"{shared_root(spark)}/{lake}/raw/bronze_events")
    assert names == ["daily_during", "daily_after"] and set(raw.columns) == set(refresh.RAW_COLUMNS)
