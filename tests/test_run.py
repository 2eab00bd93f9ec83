"""The end-to-end run on the small tables."""

from __future__ import annotations

from datetime import date, datetime, timezone
from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import table_counts
from tidemark.plans.run import GateFailed, RunConfig, RunLog, reliability_report, run
from tidemark.session import scratch_path
from tidemark.sources import records, tables
from tidemark.sources.lake import Lake


def test_run_rerun_backfill_and_report(spark, sf_dir):
    source, root = scratch_path(spark, "records"), scratch_path(spark, "lake")
    lake = Lake(spark, root)
    for name in tables.BUILDERS:
        tables.change_records(spark, sf_dir, name, 0).write.mode("append").parquet(source)

    def go(**conf):
        return run(spark, RunConfig(
            root, lambda s: records.file_stream(s, source), conf=conf,
            snapshot_at=datetime(2024, 2, 1, tzinfo=timezone.utc), reported_only=frozenset({"item_totals_match"})))

    go()
    tests = {r["check_name"]: r["passed"] for r in spark.read.parquet(lake.path("audit", "data_tests")).collect()}
    # line sums of the given tables do not add up to order totals
    assert len(tests) == 92 and {n for n, ok in tests.items() if not ok} == {"item_totals_match"}
    loads = lambda: sorted(
        r["inserted_record_count"] for r in lake.read("audit", "warehouse_load_runs").collect())
    size = lake.read("raw", "bronze_events").count()
    assert loads() == [size]

    # nothing new: nothing read, nothing inserted
    go()
    assert loads() == [0, size] and lake.read("raw", "bronze_events").count() == size
    assert lake.read("audit", "stream_report").first()["new_bronze_events"] == 0
    assert lake.read("snapshots", "current_customers").count() == 150

    # a backfill touches its days only
    daily = lambda: {r["order_date"]: r["orchestration_run_id"] for r in lake.read("marts", "mart_daily_commerce").collect()}
    before = daily()
    backfilled = go(run_mode="backfill", start_date="1996-01-05", end_date="1996-01-07")
    changed = {day for day, by in daily().items() if by == backfilled}
    assert changed == {d for d in before if date(1996, 1, 5) <= d <= date(1996, 1, 7)} and daily().keys() == before.keys()

    # a backfill sees changes that were loaded since: it rebuilds what the mart is made of
    delivered = lambda: {r["order_date"]: r["delivered_order_count"] for r in lake.read("marts", "mart_daily_commerce").collect()}
    old, days = delivered(), sorted(before)[-31:]
    later = tables.change_records(spark, sf_dir, "orders", 1)
    later.join(spark.read.parquet(source), ["topic", "partition", "offset"], "left_anti").select(*later.columns).write.mode("append").parquet(source)
    first, last = days[0].isoformat(), days[-1].isoformat()
    run(spark, RunConfig(
        root, lambda s: records.file_stream(s, source), conf={"run_mode": "backfill", "start_date": first, "end_date": last},
        snapshot_at=datetime(2024, 2, 2, tzinfo=timezone.utc), max_backfill_days=400,
        reported_only=frozenset({"item_totals_match", "payment_totals_match", "daily_mart_reconciles"})))
    truth = {r["order_date"]: r["n"] for r in lake.read("snapshots", "current_orders").groupBy(
        F.to_date("ordered_at").alias("order_date")).agg(F.count_if(F.col("order_status") == "delivered").alias("n")).collect()}
    new = delivered()
    assert all(new[d] == truth[d] for d in new if days[0] <= d <= days[-1])
    assert all(new[d] == old[d] for d in old if not days[0] <= d <= days[-1])
    assert {r["status"] for r in RunLog(lake).runs().collect()} == {"success"}

    frames = reliability_report(
        spark, root, table_counts(tables.entities(spark, sf_dir)),
        records.topic_summary(records.file_batch(spark, source), records.topics(tables.TOPIC_PREFIX)),
        datetime.now(timezone.utc), {"connector_is_healthy": True})
    assert frames["failed_checks"].isEmpty() and frames["status"].first()[0] == "healthy"
    assert frames["cards"].count() == 8 and spark.read.json(f"{lake.path('audit')}/report/cards").count() == 8


def test_an_invalid_result_ends_the_run(spark, sf_dir):
    source, lake = scratch_path(spark, "records"), Lake(spark, scratch_path(spark, "lake"))
    for name in tables.BUILDERS:
        tables.change_records(spark, sf_dir, name, 0).write.mode("append").parquet(source)
    with pytest.raises(GateFailed, match="item_totals_match"):
        run(spark, RunConfig(lake.root, lambda s: records.file_stream(s, source)))
    row = RunLog(lake).runs().first()
    assert (row["status"], row["failed_task_id"]) == ("failed", "data_tests")


def test_events_without_a_date_are_loaded_once(spark):
    from tidemark.plans.load import load_bronze
    from tidemark.schemas import BRONZE_SCHEMA

    lake = Lake(spark, scratch_path(spark, "lake"))
    values = {"event_id": "e{}", "source_table": "orders", "ingestion_run_id": "r"}
    rows = [tuple(values.get(f.name, "").format(i) or None for f in BRONZE_SCHEMA.fields) for i in range(5)]
    text = ", ".join(f"{f.name} string" for f in BRONZE_SCHEMA.fields)
    bronze = spark.createDataFrame(rows, text).select(*[F.col(f.name).cast(f.dataType) for f in BRONZE_SCHEMA.fields])
    assert [load_bronze(lake, bronze, f"l{i}").inserted for i in range(2)] == [5, 0]
    assert lake.read("raw", "bronze_events").count() == 5


def test_a_failing_step_is_recorded(spark, tmp_path):
    lake = Lake(spark, scratch_path(spark, "lake"))

    def broken(session):
        raise RuntimeError("no source " + "x" * 5000)

    with pytest.raises(RuntimeError):
        run(spark, RunConfig(lake.root, broken))
    row = RunLog(lake).runs().first()
    assert (row["status"], row["failed_task_id"]) == ("failed", "bronze_stream") and len(row["error_message"]) > 4000


def test_run_log_folds_restarts_and_details(spark):
    log = RunLog(Lake(spark, scratch_path(spark, "lake")))
    with pytest.raises(LookupError):
        log.succeed("r1")
    at = [datetime(2024, 1, 1, 0, n) for n in range(6)]
    log.start("r1", "d", "backfill", date(2024, 1, 1), date(2024, 1, 2), {"a": 1, "b": 1}, at[0])
    log.fail("r1", "load", "boom", {"b": 2}, at[1])
    row = log.runs().first()
    assert (row["status"], row["duration_seconds"], row["error_message"]) == ("failed", 60, "boom")
    assert row["details"] == {"a": "1", "b": "2"}
    log.start("r1", "d", "incremental", details={"c": 3}, at=at[2])
    row = log.runs().first()
    assert (row["status"], row["completed_at"], row["details"]) == ("running", None, {"c": "3"})
    log.succeed("r1", {"c": 4}, at[4])
    row = log.runs().first()
    assert (row["status"], row["duration_seconds"], row["failed_task_id"], row["details"]) == (
        "success", 120, None, {"c": "4"})


def test_stream_equals_batch_and_keeps_quarantine_apart(spark, sf_dir):
    from tidemark.operators.events import bronze_events, quarantined_events, valid_events
    from tidemark.streaming.bronze import BronzePaths, read_bronze, read_quarantine, run_bronze_stream

    root = scratch_path(spark, "stream")
    paths, source = BronzePaths.below(root), f"{root}/records"
    tables.stream_records(spark, sf_dir).write.parquet(source)
    read = run_bronze_stream(records.file_stream(spark, source, max_files=2), paths, "r")
    assert read == {"valid_input_rows": 1000, "quarantine_input_rows": 1000}
    batch = bronze_events(records.file_batch(spark, source), "r").drop("ingested_at")
    for got, expected in (
        (read_bronze(spark, paths), valid_events(batch)), (read_quarantine(spark, paths), quarantined_events(batch))):
        got = got.select(*batch.columns)
        assert got.count() == expected.count() and got.exceptAll(expected).isEmpty()
    assert {p["source_table"] for p in read_bronze(spark, paths).select("source_table").distinct().collect()} == set(
        tables.STREAM_TABLES)
