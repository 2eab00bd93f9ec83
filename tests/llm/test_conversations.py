"""Conversation repair against an enumeration of all edits, and long conversations against the agenda over the whole."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversations as c
from tidemark.llm.conversations import DELETE, INSERT, LAST, REROLE, TRUNCATED, lightest, op13_conversations, repaired_conversations, whole

SCHEMA = "conv_id long, turn long, role string, text string, present string, fault string, segment string"


def every_repair(rows, longest):
    """Least (cost, audit) by trying every string of edits that reads all rows."""
    best = None
    for size in range(len(rows), longest + 1):
        for edits in product("DIKR", repeat=size):
            if size - edits.count("I") != len(rows):
                continue
            source, cost, roles = iter(rows), 0, [""]
            for edit in edits:
                if edit == "I":
                    cost, roles = cost + INSERT, [r + x for r in roles for x in "ua"]
                    continue
                initial, fault = next(source)
                if edit == "D":
                    cost += DELETE
                    continue
                if fault in (c.BLANK, c.DUPLICATE):
                    roles = []
                cost += (REROLE if edit == "R" else 0) + (TRUNCATED if fault == c.CUT else 0)
                roles = [r + x for r in roles for x in ("ua" if edit == "R" else initial or "?")]
            if any(re.fullmatch(r"(s?(ua)+)?", r) for r in roles):
                found = (cost, "".join(edits))
                best = found if best is None else min(best, found)
    return best


def test_the_agenda_finds_the_cheapest_edits():
    draw = random.Random(2)
    shapes = [()] + [tuple((draw.choice(["s", "u", "a", "t", ""]), draw.choice([0, 0, 1, 2, 3])) for _ in range(n)) for n in (1, 1, 2, 2, 3, 3, 3, 4, 4) for _ in range(3)]
    for rows in shapes:
        assert lightest(rows, LAST, (c.NOTHING,))[c.NOTHING] == every_repair(rows, len(rows) + 3), rows


def plain(rows):
    """Results of (conv_id, turn, role, text) rows by conversation."""
    by: dict = {}
    for conv, turn, role, text in rows:
        here = by.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        here += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = {}
    for conv, here in by.items():
        here.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        sound = lambda t: 1 if not re.search(r"[^\x20\x09-\x0D]", t) else 0 if re.search(r"[.!?][\x20\x09-\x0D]*\Z", t) else 3
        out[conv] = whole([c.Row(*r, True, sound(r[2])) for r in here])
    return out


def rows_for(conv, count, draw):
    return [(conv, draw.choice([None, t // 2, t, t + 5]), draw.choice(["user", "assistant", "system", "tool", None, ""]),
             draw.choice(["", "a.", "b", "c!\n", None, f"t{t}.", f"x{t}", " \n", "é?"])) for t in range(count)]


@pytest.fixture
def no_coalescing(spark):
    """Rows stay in as many partitions as there are shuffle partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def check(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3)
    got = op13_conversations(frame).collect()
    assert len(got) == len({r[0] for r in rows})
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == plain(rows)


def test_small_conversations(spark, no_coalescing):
    draw = random.Random(11)
    rows = [row for conv in [None, *range(60)] for row in rows_for(conv, draw.randrange(1, 9), draw)]
    check(spark, rows + rows[:20])
    frame = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA)
    assert op13_conversations(frame.limit(0)).collect() == []
    as_text = op13_conversations(frame.withColumn("conv_id", F.col("conv_id").cast("string"))).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in as_text} == {None if k is None else str(k): v for k, v in plain(rows).items()}


def test_a_conversation_that_spans_partitions(spark, no_coalescing, monkeypatch):
    draw = random.Random(12)
    rows = rows_for(5, 2500, draw) + rows_for(None, 900, draw) + rows_for(6, 4, draw) + rows_for(4, 2, draw)
    check(spark, rows)
    monkeypatch.setattr(c, "BYTES", 50)
    check(spark, rows[:300])


def test_a_conversation_of_which_nothing_is_left(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = op13_conversations(spark.createDataFrame([(gone, 0, "user", "x.", "", "", "")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_very_long_texts(spark):
    rows = spark.createDataFrame([(1, 0, "user", "x" * 3_000_000, True), (1, 1, "assistant", "y. " * 1_000_000, True)],
                                 "conv_id long, turn long, role string, text string, present boolean")
    got = repaired_conversations(rows).first()
    assert (got["audit"], got["cost"], got["truncated"]) == ("KK", 3, 1)
    assert got["repaired_sha256"] == hashlib.sha256(("user:" + "x" * 3_000_000 + "\nassistant:" + "y. " * 1_000_000).encode()).hexdigest()
