"""Times the headline queries and the steps of a run; prints one JSON line.

Every query is run once to warm up and then three times; its time is the
median. The steps of a run (stream, load, reload, build, backfill) write
tables, so each is timed once, after a warm-up run on sf0.001.
"""

from __future__ import annotations

import contextlib
import json
import os
import sys
import time
from datetime import date, datetime, timezone
from functools import reduce
from statistics import median

from pyspark.sql import DataFrame, SparkSession

from tidemark.catalog.queries import catalog
from tidemark.plans import load, refresh
from tidemark.plans.run import publish, tests_of
from tidemark.session import build_session, scratch_path
from tidemark.sources import records, tables
from tidemark.sources.lake import Lake
from tidemark.streaming.bronze import BronzePaths, read_bronze, run_bronze_stream

HEADLINE = (
    "event_validity", "strict_validity", "typed_order_items", "dedup_events", "incremental_new_events",
    "current_orders", "current_order_items", "scd2_history", "fact_orders_asof", "fact_order_items", "mart_daily",
    "mart_daily_backfill", "mart_customer_value", "mart_product_performance", "check_item_totals",
    "dataset_problems", "schema_drift", "event_order", "bronze_profile", "recovered_failures")


def drain(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    started = time.perf_counter()
    action()
    return time.perf_counter() - started


def build_and_test(lake: Lake, run_id: str, snapshot_at: datetime, first: date | None = None, last: date | None = None) -> None:
    one = refresh.Build(lake, run_id, snapshot_at, first, last)
    tested = tests_of(lake, one.run(), one.changed_tables())
    publish(lake, one, tested)


def run_steps(spark: SparkSession, sf_dir: str) -> tuple[dict[str, float], int]:
    """One run over the change logs of all entities, step by step."""
    source, root = scratch_path(spark, "bench-records"), scratch_path(spark, "bench-lake")
    logs = [tables.change_records(spark, sf_dir, name) for name in tables.BUILDERS]
    reduce(DataFrame.unionByName, logs).write.parquet(source)
    lake, paths = Lake(spark, root), BronzePaths.below(root)
    snapshot_at = datetime(2024, 2, 1, tzinfo=timezone.utc)
    steps = {
        "run_stream": lambda: run_bronze_stream(records.file_stream(spark, source), paths, "bench"),
        "run_first_load": lambda: load.load_bronze(lake, read_bronze(spark, paths), "first"),
        # what an incremental run does when its stream has read nothing new
        "run_reload": lambda: load.load_runs(lake, read_bronze(spark, paths), ["nothing-new"], "again"),
        "run_reload_all": lambda: load.load_bronze(lake, read_bronze(spark, paths), "all-again"),
        "run_build": lambda: build_and_test(lake, "bench", snapshot_at),
        "run_backfill_3_days": lambda: build_and_test(lake, "backfill", snapshot_at, date(1996, 1, 5), date(1996, 1, 7)),
    }
    return {name: timed(step) for name, step in steps.items()}, read_bronze(spark, paths).count()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    # Spark prints to stdout in places; the JSON line must stand alone there
    with contextlib.redirect_stdout(sys.stderr):
        spark = build_session(
            "bench", f"local[{cpus}]",
            **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "20g",
               "spark.ui.showConsoleProgress": "false"})
        spark.sparkContext.setLogLevel("ERROR")
        seconds: dict[str, float] = {}
        for name, query in catalog().items():
            if name in chosen:
                drain(query(spark, sf_dir))
                seconds[name] = median(timed(lambda: drain(query(spark, sf_dir))) for _ in range(3))
                print(f"{name} {seconds[name]:.3f}", flush=True)
        events = None
        if not sys.argv[1:]:
            small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
            run_steps(spark, small)
            steps, events = run_steps(spark, sf_dir)
            seconds |= steps
        version = spark.version
        spark.stop()
    line = {
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": {name: round(value, 3) for name, value in seconds.items()},
        "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus), "spark": version,
    }
    if events:
        line["stream_events"] = events
        line["stream_events_per_second"] = round(events / seconds["run_stream"], 1)
        line["load_rows_per_second"] = round(events / seconds["run_first_load"], 1)
    print(json.dumps(line))


if __name__ == "__main__":
    main()
