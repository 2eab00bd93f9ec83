"""Every registered query against its expected SQL."""

from __future__ import annotations

import pytest
from compare import connect, difference

from tidemark.catalog.expected_sql import EXPECTED
from tidemark.catalog.queries import catalog

QUERIES = catalog()


@pytest.fixture(scope="module")
def sql(sf_dir):
    return connect(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_matches_sql(spark, sf_dir, sql, name):
    assert difference(QUERIES[name](spark, sf_dir), sql, EXPECTED[name]) is None


def test_comparison_sees_a_difference(spark, sql):
    frame = spark.sql("SELECT 1L AS a, 2.0D AS b")
    assert difference(frame, sql, "SELECT CAST(1 AS BIGINT) AS a, CAST(2 AS DOUBLE) AS b") is None
    assert difference(frame, sql, "SELECT CAST(1 AS BIGINT) AS a, CAST(2.01 AS DOUBLE) AS b")
    assert difference(frame, sql, "SELECT CAST(1 AS BIGINT) AS a, CAST(2 AS DOUBLE) AS c")


def test_approximate_percentiles_are_near(spark, sf_dir):
    near = QUERIES["latency_percentiles_approx"](spark, sf_dir).first()
    exact = QUERIES["latency_percentiles"](spark, sf_dir).first()
    assert near["measured_events"] == exact["measured_events"] and near["maximum_ms"] == exact["maximum_ms"]
    assert abs(near["median_ms"] - exact["median_ms"]) <= 1 and abs(near["p95_ms"] - exact["p95_ms"]) <= 1
