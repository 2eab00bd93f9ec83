"""Ranked lexical search against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lexical
from tidemark.llm.lexical import Block, Postings, op11_lexical, search

from .cases import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string, score string, rank string"


def terms(text):
    return [t.translate(LOWER) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def plain(rows, items, k):
    counts = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    sizes = [sum(c.values()) for _, c in counts]
    total, length = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for (doc_id, count), n in zip(counts, sizes):
            score = 0
            for t in set(terms(text)) & count.keys():
                w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * count[t] // (1000 * count[t] + 8 * (10 + 90 * n * total // length)))
            if score > 0:
                scored.append((-score, doc_id is not None, doc_id, score))
        out += [(item_id, rank, row[2], row[3]) for rank, row in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_plain_python(spark):
    rows = documents(spark).withColumnRenamed("size", "rank")
    items = [(1, "Alpha1 beta3, alpha7 changed ONE"), (2, None), (3, ""), (4, "..!"), (5, "w1x1 w5x5 tail tail"), (5, "two"), (6, "nowhere"), (7, "d é ÄÖ 😀")]
    got = found(op11_lexical(rows, spark.createDataFrame([(*i, "x", "y") for i in items] + [(5, "two", "x", "y")], ITEMS)))
    assert got == plain([(r["doc_id"], r["text"]) for r in rows.collect()], items, 10)
    assert got
    assert found(op11_lexical(rows.limit(0), spark.createDataFrame([(1, "a", "", "")], ITEMS))) == []
    assert found(op11_lexical(rows, spark.createDataFrame([], ITEMS))) == []


@pytest.mark.parametrize("postings, query_terms", [(1 << 21, 1 << 18), (40, 3)])
def test_blocks_of_documents_and_queries_change_nothing(spark, monkeypatch, postings, query_terms):
    monkeypatch.setattr(lexical, "POSTINGS", postings)
    monkeypatch.setattr(lexical, "QUERY_TERMS", query_terms)
    draw = random.Random(3)
    rows = [(f"d{draw.randrange(80)}", " ".join(f"t{int(draw.paretovariate(0.7)) % 40}" for _ in range(draw.randrange(30)))) for _ in range(200)]
    rows += [("same", "t1 t2 t3")] * 30  # more ties than places
    items = [(i, " ".join(f"t{draw.randrange(45)}" for _ in range(draw.randrange(1, 12)))) for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id string, text string").repartition(5)
    got = found(search(frame, spark.createDataFrame(items, "item_id int, text string"), 10))
    assert got == plain(rows, items, 10)


def test_the_search_stops_before_the_end_of_the_lists():
    """One document is far ahead in every list: its score is above the bound after the first round."""
    documents, terms_ = 5000, 4
    document = np.repeat(np.arange(documents), terms_)
    term = np.tile(np.arange(terms_), documents)
    impact = np.where(document < 20, 10_000 - document, 10 + document % 7)
    block = Block(Postings(document, term, impact), documents, terms_)
    at, scores = block.best(0, np.arange(terms_), 10, 0)
    assert at.tolist() == list(range(10)) and scores.tolist() == [4 * (10_000 - d) for d in range(10)]
    assert np.count_nonzero(block.scored == 0) < 100
    # a carried floor that nothing in the block reaches stops it after one round, too
    at, _ = block.best(1, np.arange(terms_), 10, 10**9)
    assert not len(at) and np.count_nonzero(block.scored == 1) <= lexical.FIRST_ROUND * terms_


def test_sums_beyond_doubles_stay_exact():
    big = (1 << 53) + 1
    block = Block(Postings(np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1]), np.array([big, big, big, big - 1])), 2, 2)
    at, scores = block.best(0, np.array([0, 1]), 2, 0)
    assert at.tolist() == [0, 1] and scores.tolist() == [2 * big, 2 * big - 1]
