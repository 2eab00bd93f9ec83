"""The end-to-end job: stream, profile, load, build, test, report, audit."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import policy
from tidemark.operators.audit import RunWindow, run_event, runs_from_log
from tidemark.operators.checks import run_checks
from tidemark.plans import profiles
from tidemark.plans.build import data_tests
from tidemark.plans.load import load_runs
from tidemark.plans.refresh import Build, expire
from tidemark.schemas import ENTITIES, LOAD_AUDIT_SCHEMA, MAX_BACKFILL_DAYS, RUN_LOG_SCHEMA
from tidemark.session import use_utc
from tidemark.sources.lake import Lake, existing
from tidemark.streaming.bronze import BronzePaths, read_bronze, read_quarantine, run_bronze_stream, stream_report


class GateFailed(RuntimeError):
    """A step's own report says that its result is not valid."""


@dataclass(frozen=True)
class RunConfig:
    """``records`` gives the stream of change records; ``snapshot_at`` is the
    time deletes are dated with, now where it is not given. ``reported_only``
    names data tests whose failures are written down but do not stop a run."""

    root: str
    records: Callable[[SparkSession], DataFrame]
    dag_id: str = "incremental"
    conf: Mapping[str, object] | None = None
    snapshot_at: datetime | None = None
    max_backfill_days: int = MAX_BACKFILL_DAYS
    reported_only: frozenset[str] = frozenset()


class RunLog:
    """The append-only audit log of runs."""

    def __init__(self, lake: Lake):
        self.lake = lake

    def read(self) -> DataFrame:
        return self.lake.read_optional("audit", "run_log", RUN_LOG_SCHEMA)

    def runs(self) -> DataFrame:
        return runs_from_log(self.read())

    def unloaded(self) -> list[str]:
        """Runs that have begun and whose load has not succeeded."""
        loads = self.lake.read_optional("audit", "warehouse_load_runs", LOAD_AUDIT_SCHEMA).filter("status = 'succeeded'")
        begun = self.read().filter("event = 'start'").select(F.concat(F.lit("load-"), "run_id").alias("load"), "run_id").distinct()
        missing = begun.join(loads.select(F.col("run_id").alias("load")), "load", "left_anti")
        return [row["run_id"] for row in missing.select("run_id").collect()]

    def _append(self, row: DataFrame) -> None:
        self.lake.append(row, "audit", "run_log")

    def start(self, run_id: str, dag_id: str, mode: str = "incremental", first=None, last=None, details=None, at=None):
        self._append(run_event(
            self.lake.spark, run_id, "start", at, dag_id=dag_id, run_mode=mode, first=first, last=last,
            details=details))

    def _require(self, run_id: str) -> None:
        known = self.read().filter((F.col("run_id") == run_id) & (F.col("event") == "start"))
        if known.isEmpty():
            raise LookupError(f"run was not found: {run_id}")

    def succeed(self, run_id: str, details=None, at=None) -> None:
        self._require(run_id)
        self._append(run_event(self.lake.spark, run_id, "success", at, details=details))

    def fail(self, run_id: str, task: str, error: str, details=None, at=None) -> None:
        self._require(run_id)
        self._append(run_event(self.lake.spark, run_id, "failed", at, failed_task=task, error=error, details=details))


def _stored_tables(lake: Lake, names) -> dict[str, DataFrame]:
    return {n: lake.read("snapshots" if n.startswith("current_") else "marts", n) for n in names}


def gate(step: str, invalid: list[str]) -> None:
    """Ends the run where a step's report names something invalid."""
    if invalid:
        raise GateFailed(f"{step}: {', '.join(sorted(invalid))}")


def stream_problems(report: DataFrame, read: Mapping[str, int]) -> list[str]:
    """What is wrong with a stream run: rows that reached neither layer."""
    row = report.first()
    written = row["new_bronze_events"] + row["new_quarantine_events"]
    return [f"{name} is {rows}, {written} were written" for name, rows in read.items() if rows != written]


def run(spark: SparkSession, config: RunConfig) -> str:
    """One run, incremental or backfill, with its audit; returns the run id.

    Both modes stream, load, bring all tables up to date and test what changed; a
    backfill narrows only the daily mart, to its window. What a run builds is
    published at its end, all tables at once. Every step is followed by a look at its
    own report, and a report that is not valid ends the run. A failing step is
    recorded with its name before the error goes on.
    """
    use_utc(spark)
    window = RunWindow.told(config.conf, config.max_backfill_days)
    lake, paths = Lake(spark, config.root), BronzePaths.below(config.root)
    run_id, log = f"run-{uuid.uuid4()}", RunLog(Lake(spark, config.root))
    log.start(run_id, config.dag_id, window.mode, window.first, window.last)
    step = "start"
    try:
        step = "bronze_stream"
        began = time.perf_counter()
        read = run_bronze_stream(config.records(spark), paths, run_id)
        streamed = lake.overwrite(
            stream_report(spark, paths, run_id, time.perf_counter() - began), "audit", "stream_report")
        gate(step, stream_problems(streamed, read))

        step = "profile_bronze"
        bronze, quarantine = read_bronze(spark, paths), read_quarantine(spark, paths)
        profile = lake.overwrite(profiles.bronze_profile(bronze, quarantine), "audit", "bronze_profile")
        gate(step, [] if profile.first()["valid"] else ["the bronze profile is not valid"])

        step = "load_raw"
        # with this run, those that wrote to bronze and died before their load
        loaded = load_runs(lake, bronze, log.unloaded(), f"load-{run_id}")
        gate(step, [] if loaded.report.first()["valid"] else ["the load verification failed"])

        step = "build"
        build = Build(lake, run_id, config.snapshot_at or datetime.now(timezone.utc), window.first, window.last)
        built = build.run()

        step = "data_tests"
        tested = tests_of(lake, built, build.changed_tables())
        failed = [r["check_name"] for r in tested.filter("NOT passed").select("check_name").collect()]
        gate(step, [name for name in failed if name not in config.reported_only])

        step = "profile_warehouse"
        metrics = lake.overwrite(
            profiles.warehouse_profile(
                {n: f for n, f in built.items() if not n.startswith("current_")}, lake.read("raw", "bronze_events"),
                {n: built[f"current_{n}"] for n in ENTITIES}),
            "audit", "warehouse_profile")
        gate(step, empty_tables(metrics))

        step = "publish"
        publish(lake, build, tested)
        log.succeed(run_id, {"inserted": loaded.inserted, "reported": ",".join(failed)})
    except Exception as error:
        log.fail(run_id, step, str(error))
        raise
    return run_id


def tests_of(lake: Lake, built: Mapping[str, DataFrame], changed: set[str]) -> DataFrame:
    """Results of all data tests, written down. Those that look at no changed table are what they were when the last
    published build was tested; a row a test."""
    raw = lake.read("raw", "bronze_events")
    known = existing(lake.spark, lake.path("audit", "published_data_tests"))
    again = None
    if known is not None:
        last = lake.publication().last()
        known = known.filter(F.col("build") == F.lit(last)).drop("build")
        again = data_tests(raw, built, changed) if not known.isEmpty() else None
    if again is None:
        return lake.overwrite(run_checks(data_tests(raw, built)), "audit", "data_tests")
    rest = known.filter(~F.col("check_name").isin([test.name for test in again]))
    return lake.overwrite(rest.unionByName(run_checks(again)) if again else rest, "audit", "data_tests")


def publish(lake: Lake, build: Build, tested: DataFrame) -> None:
    """Makes a build what readers see, keeps what its tests found, and drops what only old builds needed."""
    build.publish()
    lake.overwrite(tested.withColumn("build", F.lit(lake.publication().last())), "audit", "published_data_tests")
    expire(lake)


def empty_tables(metrics: DataFrame) -> list[str]:
    """Facts and dimensions that came out empty though their entity has rows."""
    pairs = {
        "dim_products": "products", "fact_orders": "orders", "fact_order_items": "order_items",
        "fact_payments": "payments", "fact_shipments": "shipments"}
    rows = {r["metric"]: r["value"] for r in metrics.filter(F.col("metric").startswith("rows.")).collect()}
    return [table for table, entity in pairs.items()
            if rows.get(f"rows.{table}") == "0" and rows.get(f"rows.current.{entity}") != "0"]


def reliability_report(
    spark: SparkSession, root: str, source_counts: DataFrame, topics: DataFrame, checked_at: datetime,
    services: Mapping[str, bool] | None = None,
) -> dict[str, DataFrame]:
    """Writes and returns the frames of the operations report as JSON below
    ``audit/report``: checks, cards, reconciliations, latency, quarantine.

    ``source_counts`` holds ``(table_name, row_count)`` of the source tables.
    """
    use_utc(spark)
    lake, paths = Lake(spark, root), BronzePaths.below(root)
    raw, checked = lake.read("raw", "bronze_events"), policy.utc_literal(checked_at)
    states = _stored_tables(lake, [f"current_{n}" for n in ENTITIES])
    bronze, quarantine = read_bronze(spark, paths), read_quarantine(spark, paths)

    bronze_row = lake.overwrite(profiles.bronze_profile(bronze, quarantine), "audit", "bronze_profile")
    latency = lake.overwrite(policy.stage_latency(raw), "audit", "stage_latency")
    tables = policy.reconcile_counts(
        source_counts, agg.table_counts({n: states[f"current_{n}"] for n in ENTITIES}))
    events = policy.reconcile_counts(
        agg.table_counts({"bronze_events": bronze}), agg.table_counts({"bronze_events": raw}))
    checks = lake.overwrite(
        profiles.reliability_checks(
            bronze_row, raw, tables, events, RunLog(lake).runs(), latency, topics, checked),
        "audit", "reliability_checks")
    deployment = spark.createDataFrame(
        [(n, bool(v)) for n, v in (services or {}).items()], "check_name string, passed boolean")
    age = raw.agg(policy.freshness(F.max("warehouse_loaded_at"), checked).alias("age_seconds"))
    groups = {"Reliability": checks, "Deployment": deployment}
    frames = {
        "checks": checks,
        "cards": profiles.dashboard_cards(
            checks, deployment, events, profiles.raw_quality(raw), bronze_row, age),
        "reconciliation": tables,
        "latency": profiles.latency_rows(latency),
        "failed_checks": profiles.failed_checks(groups),
        "quarantine_reasons": agg.count_by(quarantine, "invalid_reason"),
        "status": profiles.overall_status(groups),
    }
    for name, frame in frames.items():
        frame.write.mode("overwrite").json(f"{lake.path('audit')}/report/{name}")
    return frames
