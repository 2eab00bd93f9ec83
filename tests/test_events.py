from __future__ import annotations

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark.functions.envelope import parse_envelope
from tidemark.functions.keys import checked_event_id, event_id, position_problem
from tidemark.operators.events import bronze_events, record_key
from tidemark.operators.staging import normalised_events, typed_events
from tidemark.operators.strict import strict_validity
from tidemark.schemas import BRONZE_COLUMNS, RECORD_SCHEMA
from tidemark.sources.lake import require_columns


def envelope(op="c", before=None, after=None, source=None, **extra):
    return {"op": op, "before": before, "after": after,
            "source": {"table": "customers", "ts_ms": 5, "lsn": 6, "txId": 7} if source is None else source,
            "ts_ms": 1_704_067_200_000, **extra}


def records(spark, *values, topic="shop.public.customers"):
    from datetime import datetime

    rows = [(b"k", None if v is None else (v if isinstance(v, str) else json.dumps(v, separators=(",", ":"))).encode(), topic, 0, n,
             datetime(2024, 2, 2)) for n, v in enumerate(values)]
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def by_offset(frame, *columns):
    return [tuple(r) for r in frame.orderBy("kafka_offset").select(*columns).collect()]


def test_event_ids_depend_on_the_position_only(spark):
    frame = spark.createDataFrame([("t", 0, 1), ("t", 0, 1), ("t", 0, 2)], "topic string, p int, o long")
    ids = [r[0] for r in frame.select(event_id(F.col("topic"), F.col("p"), F.col("o"))).collect()]
    assert ids[0] == ids[1] != ids[2] and all(len(i) == 64 for i in ids)


@pytest.mark.parametrize("row, problem", [
    ((" ", 0, 0), "empty_topic"), (("t", -1, 0), "negative_partition"), (("t", 0, -1), "negative_offset")])
def test_bad_positions_are_refused(spark, row, problem):
    frame = spark.createDataFrame([row], "topic string, p int, o long")
    position = (F.col("topic"), F.col("p"), F.col("o"))
    assert frame.select(position_problem(*position)).first()[0] == problem
    with pytest.raises(PySparkException):
        frame.select(checked_event_id(*position)).collect()


def test_wrapped_and_bare_envelopes_project_alike(spark):
    body = envelope("u", before={"customer_id": 1}, after={"customer_id": 1, "note": "a b"})
    wrapped = {"schema": {"name": "n"}, "payload": body}
    frame = bronze_events(records(spark, wrapped, body), "r")
    assert frame.columns == BRONZE_COLUMNS
    rows = by_offset(frame, "operation", "source_timestamp_ms", "source_lsn", "source_transaction_id", "after_json",
                     "payload_json", "source_table", "invalid_reason")
    assert rows[0] == rows[1]
    assert rows[0][:4] == ("u", 5, 6, 7) and json.loads(rows[0][4]) == {"customer_id": 1, "note": "a b"}
    assert by_offset(frame, "schema_name") == [("n",), (None,)]
    assert by_offset(frame, "before_json")[0] == ('{"customer_id":1}',)


def test_event_time_falls_back_to_the_record(spark):
    frame = bronze_events(records(spark, envelope(), {"op": "c"}), "r")
    days = [str(d) for d, in by_offset(frame, "event_date")]
    assert days == ["2024-01-01", "2024-02-02"]


def test_bad_numbers_become_null_instead_of_failing(spark):
    frame = bronze_events(records(spark, envelope(source={"ts_ms": "soon", "lsn": 1.5})), "r")
    assert by_offset(frame, "source_timestamp_ms", "invalid_reason") == [(None, None)]


def test_lenient_reasons(spark):
    frame = bronze_events(records(
        spark, None, "not json", {"op": "x"}, {"op": "c"}, "[1]", "null", {"payload": "text", "op": "c"},
        '{"op":"c"} trailing'), "r")
    assert [r for r, in by_offset(frame, "invalid_reason")] == [
        "null_kafka_value", "missing_or_invalid_operation", "unsupported_operation", None,
        "missing_or_invalid_operation", "missing_or_invalid_operation", None, None]
    other = bronze_events(records(spark, {"op": "c"}, topic="a.b.other"), "r")
    assert by_offset(other, "source_table", "invalid_reason") == [("other", "unexpected_source_table")]


def test_strict_reasons(spark):
    row = {"customer_id": 1}
    cases = [
        (None, "invalid_json"), ("not json", "invalid_json"), ("[1]", "payload_not_object"),
        ("null", "payload_not_object"), ({"payload": None}, "missing_payload"), ({"payload": "text"}, "missing_payload"),
        ({"payload": '{"op":"c"}'}, "missing_payload"), ({"source": {}}, "missing_operation"),
        (envelope("x"), "unsupported_operation"), (envelope("c", source=[1]), "missing_source_table"),
        (envelope("c", source={"table": "other"}), "unexpected_source_table"),
        (envelope("d", after=row), "missing_before_record"), (envelope("c", before=row), "missing_after_record"),
        (envelope("c", after=[1]), "missing_after_record"), (envelope("d", before=row), None),
        ({"payload": envelope("r", after=row)}, None), (envelope("u", before=row, after=row), None)]
    frame = strict_validity(bronze_events(records(spark, *[c for c, _ in cases]), "r"))
    assert [r for r, in by_offset(frame, "strict_reason")] == [reason for _, reason in cases]
    assert by_offset(frame, "record_json")[-1] == ('{"customer_id":1}',)


def test_record_key_uses_either_image(spark):
    frame = records(spark, envelope("d", before={"customer_id": 3}), {"payload": envelope("c", after={"customer_id": 4})})
    parsed = frame.select("offset", parse_envelope(F.col("value").cast("string")).alias("e"))
    assert [r[1] for r in parsed.select("offset", record_key("e", "customer_id")).orderBy("offset").collect()] == [3, 4]


def test_bad_casts_are_listed_not_fatal(spark):
    rows = [envelope("c", after={"customer_id": "12x", "created_at": "", "updated_at": "2024-01-01T00:00:00Z"}),
            envelope("c", after={"customer_id": 12, "first_name": ""})]
    raw = bronze_events(records(spark, *rows), "r").withColumn("warehouse_loaded_at", F.current_timestamp())
    typed = typed_events(normalised_events(raw), "customers")
    assert by_offset(typed, "customer_id", "cast_failed", "created_at", "first_name") == [
        (None, ["customer_id"], None, None), (12, [], None, "")]


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="a, c$"):
        require_columns(spark.createDataFrame([(1,)], "b int"), ["c", "b", "a"])
