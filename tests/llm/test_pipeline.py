"""The corpus pipeline on a given table and on awkward rows."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm.common import stored

from .cases import as_table, documents


def test_stages_keep_columns_and_only_remove_or_redact(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        rows = docs.collect()
        assert {r["doc_id"] for r in rows} <= set(before) and len(rows) == len({r["doc_id"] for r in rows})
        if at < 4:
            assert docs.columns == columns
        if at < 3:
            assert all(before[r["doc_id"]] == r["text"] for r in rows)
        before = {r["doc_id"]: r["text"] for r in rows}
    assert all(r["copies"] >= 1 and r["taken"] == r["copies"] * r["size"] for r in rows) and len(rows) > 50


def test_awkward_rows_pass_through(spark, sf_dir, tmp_path):
    """Nulls, empty and very long texts, repeated rows and ids, and columns named as the stages name their own."""
    mine = ("_text_key", "_quality_score", "_other_id", "_other_key", "_chars")
    awkward = documents(spark).withColumns({name: F.lit("clash") for name in mine})
    docs = as_table(awkward, str(tmp_path / "docs"))
    columns = docs.columns
    key = lambda row: (row["doc_id"], row["text"])
    before = Counter(map(key, docs.collect()))
    left = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        rows = docs.collect()
        left[name] = Counter(map(key, rows))
        # the last stage has columns of its own beside them
        assert docs.columns == columns or name == corpus_pipeline.STAGES[-1][0]
        assert all(row[c] == "clash" for row in rows for c in mine)
        if name != "PII":
            assert left[name] <= before, name
        before = left[name]
    judged, single, clean, hidden, mixed = left.values()
    # the equal rows of doc 12, copies (1, 2) and near copies (1, 3; 9, 10) leave one each; rows without words are no copies
    assert max(single.values(), default=0) <= 1
    ids = [doc_id for doc_id, _ in single]
    assert all(sum(i in group for i in ids) == min(1, sum(any(k[0] == i for k in judged) for i in group)) for group in ((1, 2, 3), (9, 10), (12,)))
    assert {k for k in judged if not (k[1] or "").strip()} <= set(single)
    assert sum(hidden.values()) == sum(clean.values()) and not any("a.b@c.example.org" in (text or "") for _, text in hidden)
    assert {doc_id for doc_id, _ in mixed} <= {doc_id for doc_id, _ in hidden}


def test_stages_of_an_empty_table(spark, sf_dir):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "test-stage")
        assert docs.count() == 0
