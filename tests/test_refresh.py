"""States, versions and builds that follow changes; as-of lookups, event history, gaps and lateness."""

from __future__ import annotations

import random
from datetime import date, datetime, timezone
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.asof import as_of
from tidemark.operators.event_history import history_from_events
from tidemark.operators.events import bronze_events, valid_events
from tidemark.operators.policy import event_order, offset_gaps
from tidemark.operators.staging import normalised_events, typed_events
from tidemark.plans import refresh
from tidemark.plans.load import load_bronze
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.sources.files import children, exists, read_text, write_text
from tidemark.sources.lake import Lake
from tidemark.sources.versions import Publication, StateTable, VersionedTable
from tidemark.streaming.lateness import start_order_stream

NOW = datetime(2024, 3, 2, tzinfo=timezone.utc)


def rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


# ---- files and versions -----------------------------------------------------

def test_small_files_are_put_in_place_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/deep/er/one.json"
    assert children(spark, f"{tmp_path}/deep") == [] and not exists(spark, path)
    for text in ("first", "second é"):
        write_text(spark, path, text)
        assert read_text(spark, path) == text and children(spark, f"{tmp_path}/deep/er") == ["one.json"]


def test_a_version_rewrites_only_what_it_touches(spark, tmp_path):
    table = VersionedTable(spark, f"{tmp_path}/t")
    first = spark.createDataFrame([(i, "a", f"m{i % 3}") for i in range(9)] + [(None, "n", "m0")], "id long, v string, m string")
    assert table.replace_keys(None, 1, first, first, "id", F.col("m")) == 1
    # id 4 moves from m1 to a new part, id 0 goes, the row without id changes
    new = spark.createDataFrame([(4, "b", "m9", 1.5), (None, "x", "m0", None)], "id long, v string, m string, added double")
    gone = spark.createDataFrame([(4,), (0,), (None,)], "id long")
    assert table.replace_keys(1, 2, new, gone, "id", F.col("m")) == 2
    assert table.manifest(2)[0] == {"m0": 2, "m1": 2, "m2": 1, "m9": 2}
    assert rows(table.read(1), "id", "v") == rows(first, "id", "v")
    kept = [(i, "a", None) for i in range(1, 9) if i != 4]
    assert rows(table.read(2), "id", "v", "added") == sorted([*kept, (4, "b", 1.5), (None, "x", None)], key=repr)
    assert rows(table.read(2, ["m9", "none"]), "id") == [(4,)]
    # nothing to replace: the version stays
    assert table.replace_keys(2, 3, new.limit(0), gone.limit(0), "id", F.col("m")) == 2
    log = Publication(spark, f"{tmp_path}/published")
    log.commit(1, {"t": (1, None)})
    log.commit(2, {"t": (2, "note")})
    assert log.tables(1) == {"t": (1, None)} and log.tables() == {"t": (2, "note")} and log.last() == 2
    # of version 1 only m2 is still needed
    assert log.expire({"t": table}, keep=1) == 2 and log.builds() == [2]
    assert children(spark, f"{tmp_path}/t/data/version=1") == ["_SUCCESS", "_part=m2"]
    assert rows(table.read(2), "id", "v", "added") == sorted([*kept, (4, "b", 1.5), (None, "x", None)], key=repr)


STATE = ("id long, v string, event_id string, is_deleted boolean, source_timestamp_ms long, kafka_timestamp timestamp, kafka_offset long")


def test_state_keeps_the_newest_event_whatever_the_order_of_loads(spark, tmp_path):
    draw = random.Random(4)
    at = datetime(2024, 1, 1)
    events = [(draw.choice([None, *range(30)]), f"v{n}", f"e{n}", draw.random() < 0.2, draw.randrange(200), at, n) for n in range(300)]
    state = StateTable(VersionedTable(spark, f"{tmp_path}/s"), "id", 6)
    version, shuffled = None, draw.sample(events, len(events))
    for number, low in enumerate(range(0, 300, 75), start=1):
        version, changes = state.merge(version, number, spark.createDataFrame(shuffled[low:low + 75], STATE))
        assert (changes is None) == (number == 1)
    newest = {}
    for event in events:
        if event[0] not in newest or (event[4], event[6]) > (newest[event[0]][4], newest[event[0]][6]):
            newest[event[0]] = event
    assert rows(state.read(version), "id", "event_id") == sorted([(e[0], e[2]) for e in newest.values()], key=repr)
    # one key: one part is rewritten, one change is told
    last, changes = state.merge(version, 9, spark.createDataFrame([(7, "new", "z", False, 999, at, 999), (7, "old", "y", False, 1, at, 1)], STATE))
    assert list(state.table.manifest(last)[0].values()).count(9) == 1
    assert rows(changes, "old.event_id", "new.event_id") == [(newest[7][2], "z")]
    # an event that comes too late changes nothing
    _, changes = state.merge(last, 10, spark.createDataFrame([(7, "late", "w", False, 998, at, 1)], STATE))
    assert changes.count() == 0


# ---- builds -----------------------------------------------------------------

def load(lake: Lake, sf_dir: str, versions, names=tables.BUILDERS) -> None:
    logs = [tables.change_records(lake.spark, sf_dir, name) for name in names]
    day = F.floor((F.unix_millis("timestamp") - tables.LOG_EPOCH_MS) / tables.DAY_MS)
    records = reduce(DataFrame.unionByName, logs).filter(day.isin(list(versions)))
    load_bronze(lake, valid_events(bronze_events(records, "r")), f"load-{versions}")


UNLIKE = {"orchestration_run_id", "refreshed_at", "warehouse_loaded_at"}


def contents(built):
    return {name: rows(frame, *sorted(set(frame.columns) - UNLIKE)) for name, frame in built.items()}


@pytest.fixture(scope="module")
def grown(spark, sf_dir):
    """A lake built after its first load, after its second, and a backfill without a load; and one built at once."""
    lake = Lake(spark, scratch_path(spark, "lake"))
    load(lake, sf_dir, [0])
    first = refresh.Build(lake, "first", NOW)
    first.run()
    first.publish()
    load(lake, sf_dir, [1, 2, 3])
    second = refresh.Build(lake, "second", NOW)
    built = second.run()
    return lake, first, second, built


def test_a_build_on_changes_equals_one_from_the_start(spark, sf_dir, grown):
    lake, first, second, built = grown
    # not published yet: readers see the first build
    assert lake.read("marts", "fact_orders").select("warehouse_loaded_at").distinct().count() == 1
    assert lake.publication().last() == 1
    second.publish()
    whole = Lake(spark, scratch_path(spark, "lake"))
    load(whole, sf_dir, [0, 1, 2, 3])
    expected = contents(refresh.Build(whole, "whole", NOW).run())
    got = contents(built)
    # the history has seen one snapshot more, and with it the keys of the versions
    unlike = {"snap_customers", "dim_customers", "fact_orders", "mart_customer_value"}
    for name in expected:
        if name not in unlike:
            assert got[name] == expected[name], name
    assert rows(built["fact_orders"], "order_id", "order_total", "order_status") == rows(
        refresh.Build(whole, "again", NOW).run()["fact_orders"], "order_id", "order_total", "order_status")
    assert got["current_customers"] == expected["current_customers"]


def test_a_backfill_reads_and_writes_its_months_only(spark, grown):
    lake, _, second, _ = grown
    if lake.publication().last() == 1:
        second.publish()
    start, end = date(1996, 1, 30), date(1996, 2, 3)
    seen = []

    class Watched(refresh.Build):
        def read(self, name, parts=None):
            frame = super().read(name, parts)
            if parts is not None:
                seen.extend(frame.inputFiles())
            return frame

    build = Watched(lake, "backfill", NOW, start, end)
    build.run()
    assert build.changes == {} and build.changed_tables() == {refresh.DAILY}
    assert {f.split("_part=")[1].split("/")[0] for f in seen} <= {"1996-01", "1996-02"} and seen
    folders, _ = lake.versioned(refresh.DAILY).manifest(build.after[refresh.DAILY][0])
    written = {p for p, f in folders.items() if f == build.number}
    assert written and written <= {"1996-01", "1996-02"}
    days = build.read(refresh.DAILY)
    changed = {r["order_date"] for r in days.filter("orchestration_run_id = 'backfill'").collect()}
    assert changed == {r["order_date"] for r in days.filter(F.col("order_date").between(F.lit(start), F.lit(end))).collect()}
    assert refresh.expire(lake, keep=1) >= 0
    assert lake.read("marts", "fact_orders").count() == build.read("fact_orders").count()


# ---- as-of, history, gaps, lateness --------------------------------------------

def test_as_of_equals_the_range_join(spark):
    draw = random.Random(6)
    versions = []
    for key in range(6):
        cuts = sorted(draw.sample(range(0, 4000), 12))
        versions += [(key, f"{key}-{a}", datetime.fromtimestamp(a * 3600, timezone.utc), None if b is None else datetime.fromtimestamp((b - draw.choice([0, 0, 3])) * 3600, timezone.utc))
                     for a, b in zip(cuts, [*cuts[1:], draw.choice([None, 4100])])]
    asked = [(n, draw.choice([None, *range(7)]), draw.choice([None, *[datetime.fromtimestamp(draw.randrange(4200) * 3600, timezone.utc)] * 9])) for n in range(500)]
    v = spark.createDataFrame(versions, "k long, name string, valid_from timestamp, valid_to timestamp")
    r = spark.createDataFrame(asked, "n long, k long, at timestamp")
    got = as_of(r, v, "k", "at", ["name"])
    on = (r.k == v.k) & (r.at >= v.valid_from) & (v.valid_to.isNull() | (r.at < v.valid_to))
    assert rows(got, "n", "name") == rows(r.join(v, on, "left"), "n", "name")
    assert got.columns == ["n", "k", "at", "name"]


def test_as_of_on_one_busy_key_makes_no_pairs(spark):
    moment = lambda c: F.timestamp_seconds(F.col("id") * 60 + c)
    v = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("name"), moment(0).alias("valid_from"), moment(60).alias("valid_to"))
    r = spark.range(100_000).select(F.lit(1).alias("k"), F.col("id").alias("n"), moment(30).alias("at"))
    row = as_of(r, v, "k", "at", ["name"]).agg(F.count("*"), F.count_if(F.col("n") == F.col("name"))).first()
    assert tuple(row) == (100_000, 100_000)


def test_history_from_events_cuts_late_events_in(spark, sf_dir):
    from tidemark.catalog.queries import _raw_log

    typed = typed_events(normalised_events(_raw_log(spark, sf_dir, "customers").filter("false")), "customers")
    layout = T.StructType([T.StructField(f.name, f.dataType) for f in typed.schema.fields])
    def event(key, ms, city, deleted=False, offset=0):
        values = {"customer_id": key, "city": None if deleted else city, "is_deleted": deleted, "source_timestamp_ms": ms, "event_id": f"{key}-{ms}-{offset}",
                  "kafka_offset": offset, "operation": "d" if deleted else "u"}
        return tuple(values.get(f.name) for f in layout.fields)
    events = [event(1, 1000, "a"), event(1, 3000, "b"), event(1, 2000, "late", offset=9), event(1, 4000, "b", offset=2), event(1, 5000, "", True),
              event(1, 6000, "", True), event(1, 7000, "c"), event(1, 7000, "d", offset=5), event(2, 1000, "", True), event(3, 1000, "x"), event(None, 1, "y")]
    for block in (10**9, 1500):
        got = history_from_events(spark.createDataFrame(events, layout), "customers", block)
        ms = lambda c: F.unix_millis(c).alias(c)
        assert rows(got, "customer_id", "city", ms("valid_from"), ms("valid_to"), "is_deleted") == sorted([
            (1, "a", 1000, 2000, False), (1, "late", 2000, 3000, False), (1, "b", 3000, 5000, False), (1, "b", 5000, 7000, True),
            (1, "d", 7000, None, False), (3, "x", 1000, None, False)], key=repr)


def test_gaps_do_not_hide_behind_repeats(spark):
    log = [("t", 0, o) for o in (0, 1, 1, 1, 5, 6, 9)] + [("t", 1, 3), (None, 0, 4), ("t", 0, None)]
    frame = spark.createDataFrame(log, "kafka_topic string, kafka_partition int, kafka_offset long")
    for block in (2, 65_536):
        got = offset_gaps(frame, block_size=block)
        assert rows(got, "kafka_topic", "kafka_partition", "first_missing", "last_missing", "missing") == [("t", 0, 2, 4, 3), ("t", 0, 7, 8, 2)]


def test_lateness_while_streaming_survives_a_batch_that_is_run_again(spark, tmp_path):
    draw = random.Random(8)
    events = [("t", o % 2, o, draw.randrange(1, 40) * 60_000) for o in range(90)]
    layout = "kafka_topic string, kafka_partition int, kafka_offset long, source_timestamp_ms long"
    for run in range(3):
        spark.createDataFrame(events[run * 30:run * 30 + 30], layout).write.mode("append").parquet(f"{tmp_path}/in")
        source = spark.readStream.schema(layout).parquet(f"{tmp_path}/in")
        start_order_stream(source, f"{tmp_path}/out", f"{tmp_path}/check", block_size=7).awaitTermination()
        if run == 1:
            # as after a crash between the sink and the commit of the batch
            (tmp_path / "check/commits/1").unlink()
            (tmp_path / "check/commits/.1.crc").unlink(missing_ok=True)
    columns = ["kafka_offset", "order_status", "event_delay_seconds"]
    expected = event_order(spark.createDataFrame(events, layout))
    assert rows(spark.read.parquet(f"{tmp_path}/out/classes"), *columns) == rows(expected, *columns)
