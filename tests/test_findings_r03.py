"""What the third review found."""

from __future__ import annotations

from datetime import datetime

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tidemark.catalog.queries import QUERIES
from tidemark.llm import pii
from tidemark.operators.dedup import new_events
from tidemark.session import shared_root
from tidemark.sources import tables
from tidemark.sources.files import children
from tidemark.sources.versions import StateTable, VersionedTable, key_bits, maybe_among

EVENTS = ("id long, v string, event_id string, is_deleted boolean, source_timestamp_ms long, kafka_timestamp timestamp, kafka_offset long")


def test_rows_kept_from_the_join_of_a_merge_are_surely_not_in_the_batch(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"))
    batch = rows.filter(F.col("id").isNull() | (F.col("id") % 10 == 3))
    judged = maybe_among(rows, "id", key_bits(batch, "id"))
    assert judged.count() == 20_000
    assert judged.join(batch, judged["id"].eqNullSafe(batch["id"]), "left_semi").filter(~F.col("_maybe")).isEmpty()
    assert judged.filter("_maybe").count() < 2_100
    assert maybe_among(rows, "id", key_bits(batch.limit(0), "id")).filter("_maybe").isEmpty()


def test_a_merge_leaves_only_its_version_on_disk(spark, tmp_path):
    at = datetime(2024, 1, 1)
    state = StateTable(VersionedTable(spark, f"{tmp_path}/s"), "id", 4)
    before = set(children(spark, shared_root(spark)))
    state.merge(None, 1, spark.createDataFrame([(i, "a", f"e{i}", False, 1, at, i) for i in range(50)], EVENTS))
    version, changes = state.merge(1, 2, spark.createDataFrame([(i, "b", f"f{i}", i == 7, 2, at, i) for i in (7, 99)], EVENTS))
    assert set(children(spark, shared_root(spark))) == before
    told = {(r["old"] and r["old"]["v"], r["new"]["id"], r["new"]["v"]) for r in changes.collect()}
    assert told == {("a", 7, "b"), (None, 99, "b")}
    assert changes.select("old.*").columns == state.read(version).columns and state.read(version).count() == 51


def test_the_incremental_state_query_keeps_one_version(spark, sf_dir):
    before = set(children(spark, shared_root(spark)))
    found = QUERIES["current_payments_incremental"](spark, sf_dir)
    made = set(children(spark, shared_root(spark))) - before
    assert len(made) == 1, made
    folder = f"{shared_root(spark)}/{made.pop()}"
    assert children(spark, f"{folder}/manifests") == ["4.json"] and found.count() > 0


def test_known_ids_are_not_sent_through_the_driver(spark):
    source, target = spark.range(100).withColumnRenamed("id", "event_id"), spark.range(40).withColumnRenamed("id", "event_id")
    fresh = new_events(source, target)
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and fresh.count() == 60


def test_loaded_rows_and_the_log_of_the_build_lie_small_on_disk(spark, sf_dir):
    before = set(children(spark, shared_root(spark)))
    QUERIES["incremental_build"](spark, sf_dir)
    made = set(children(spark, shared_root(spark))) - before
    assert not [name for name in made if name.startswith(("raw-", "records-", "state_changes-"))], made


def test_trees_for_personal_data_are_learnt_from_every_candidate(spark, monkeypatch):
    seen = []
    fit = pii.GBTClassifier.fit
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, rows, *more: seen.append(rows.count()) or fit(self, rows, *more))
    n = 40_000
    rows = spark.range(n).select(
        F.col("id").alias("uid"), F.lit(0).alias("start"), F.lit(9).alias("end"), F.lit("ip").alias("kind"), (F.col("id") % 2 == 0).alias("of_base"),
        array_to_vector(F.array((F.col("id") % 2).cast("double"), (F.col("id") % 7).cast("double"))).alias("features"))
    model, limits = pii.trained(rows)
    assert abs(seen[0] - n * (pii.FOLD - 1) / pii.FOLD) < n / 50 and limits["ip"] >= 0.5


def test_the_product_mart_of_changes_writes_no_state_that_is_read_once(spark, sf_dir):
    before = set(children(spark, shared_root(spark)))
    QUERIES["mart_product_performance_from_changes"](spark, sf_dir)
    assert set(children(spark, shared_root(spark))) == before


def test_lines_are_dealt_out_once(spark, sf_dir):
    plan = tables.versions(spark, sf_dir, "order_items")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1, plan
