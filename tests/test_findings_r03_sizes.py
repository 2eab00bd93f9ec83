"""What the third review found at size: what is shuffled, stored and held."""

from __future__ import annotations

import duckdb

from tidemark.catalog import queries
from tidemark.catalog.queries import QUERIES
from tidemark.operators.current import current_from_raw, current_keys
from tidemark.plans import marts
from tidemark.schemas import TABLES
from tidemark.session import scratch_path, shared_root
from tidemark.sources import tables
from tidemark.sources.files import children


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def made_by(spark, sf_dir, name: str) -> dict[str, str]:
    """Scratch folders a query leaves, by their name without number."""
    before = set(children(spark, shared_root(spark)))
    QUERIES[name](spark, sf_dir)
    made = set(children(spark, shared_root(spark))) - before
    return {folder.rsplit("-", 1)[0]: f"{shared_root(spark)}/{folder}" for folder in made}


def test_lines_are_not_added_up_by_task_ahead_of_their_shuffle(spark, sf_dir):
    """groups of nearly one row each."""
    assert plan(QUERIES["dataset_problems"](spark, sf_dir)).count("REPARTITION_BY_NUM") > 10


def test_counted_keys_are_those_of_the_current_state_and_read_nothing_else(spark, sf_dir):
    """F7."""
    for name in TABLES:
        raw = queries._raw_log(spark, sf_dir, name)
        keys = current_keys(raw, name)
        state = current_from_raw(raw, name).select(*keys.columns)
        assert keys.count() == state.count() > 0 and keys.exceptAll(state).isEmpty()
    assert "from_json(StructField(order_item_id,StringType,true), record_json" in plan(current_keys(queries._raw_log(spark, sf_dir, "order_items"), "order_items"))


def test_the_profile_works_out_the_daily_mart_once(spark, sf_dir):
    """F9."""
    assert "daily" in made_by(spark, sf_dir, "warehouse_profile")


def test_a_file_of_records_can_be_read_by_several_tasks(spark, sf_dir):
    """F10."""
    path = scratch_path(spark, "arrived")
    rows = tables.stream_records(spark, sf_dir).crossJoin(spark.range(60)).drop("id")
    queries._arrive(rows.coalesce(1), path)
    assert duckdb.sql(f"SELECT count(DISTINCT row_group_id) FROM parquet_metadata('{path}/*.parquet')").fetchall()[0][0] > 1


def test_the_order_stream_writes_what_the_classes_are_found_by(spark, sf_dir):
    """F12."""
    classes = spark.read.parquet(made_by(spark, sf_dir, "stream_event_order")["order"] + "/order/classes")
    assert not {"payload_json", "value_json", "after_json"} & set(classes.columns) and classes.count() > 0


def test_typed_columns_are_cast_once_in_compiled_code(spark, sf_dir):
    """F14."""
    assert "lambdafunction" not in plan(QUERIES["typed_order_items"](spark, sf_dir))


def test_the_daily_mart_of_changes_stores_what_it_reads(spark, sf_dir):
    """F16."""
    made = made_by(spark, sf_dir, "mart_daily_from_changes")
    assert {n: tuple(spark.read.parquet(made[n]).columns) for n in marts.DAILY_COLUMNS} == marts.DAILY_COLUMNS


def test_lines_are_shuffled_without_what_follows_from_them(spark, sf_dir):
    """the order once, and no unit price."""
    shuffled = plan(tables.order_items(spark, sf_dir)).split("Exchange ")[1]
    assert "unit_price" not in shuffled and "FLOOR" not in shuffled and "AS _line" in shuffled


def test_the_customer_mart_stores_what_it_reads_of_an_order(spark, sf_dir):
    """F18."""
    orders = spark.read.parquet(made_by(spark, sf_dir, "mart_customer_value_from_changes")["orders"])
    assert orders.columns == list(marts.CUSTOMER_VALUE_COLUMNS) and orders.count() > 0
