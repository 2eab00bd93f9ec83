"""Reading fields of a change envelope, wrapped in ``payload`` or bare."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SOURCE = "struct<ts_ms string, lsn string, txId string, table string>"
_BODY = f"op string, ts_ms string, before string, after string, source {_SOURCE}"

# Every field is read as text: objects keep their JSON text, numbers are cast
# leniently afterwards, so one odd value cannot fail a batch.
ENVELOPE_DDL = f"payload struct<{_BODY}>, {_BODY}, schema struct<name string>"


def parse_envelope(value: Column) -> Column:
    """One parse of the whole envelope; NULL fields where it is not JSON."""
    return F.from_json(value, ENVELOPE_DDL)


def parsed_once(rows: DataFrame, parse: Column, name: str) -> DataFrame:
    """Adds ``parse`` as a column that is computed exactly once per row.

    Spark moves filters below projections and then evaluates what they refer to
    in place, once per mention: a filter on a field would parse every document
    several times over. Filters stay above a generator, here one of one row.
    """
    return rows.select("*", F.explode(F.array(parse)).alias(name))


def envelope_field(parsed: str, path: str) -> Column:
    """Field by field: the wrapped place first, then the bare one."""
    return F.coalesce(F.col(f"{parsed}.payload.{path}"), F.col(f"{parsed}.{path}"))


def payload_text(value: Column) -> Column:
    """Text of ``payload``, or the whole value where there is none."""
    return F.coalesce(F.get_json_object(value, "$.payload"), value)
