"""Operators that SQL can express, against DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, difference

from tidemark.llm.expected_sql import EXPECTED
from tidemark.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), connect(sf_dir), EXPECTED[name]) is None


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
