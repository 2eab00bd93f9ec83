"""Conversation structure repair: the cheapest edits that give a conversation a legal order of roles, by Knuth's agenda.

A conversation is its rows by turn (nulls first; rows of one turn by role and text). Edits: Keep costs 0, Rerole to user or
assistant 3, Delete 4, Insert of an empty user or assistant row, anywhere, 3; a truncated row that is not deleted costs 3
more; blank and duplicate rows must be deleted. The repaired roles must be ``(s?(ua)+)?`` by their initials. Of the cheapest
repairs the one whose edits' initials (the audit) come first in ASCII is taken.

Deduction. An item (i, p) says: from row i on the rows can be repaired, given what stands before them (p: nothing, s, u or
a). Its value is (cost, audit). Axioms are the items behind the last row; a deduction puts one edit in front of an item.
Items are popped from an agenda by (cost, rows behind i, audit); the first value popped is final, and the search ends when the
goal, item (0, nothing), is popped. Every deduction raises the cost or the rows, so it is superior; putting an edit in front keeps the order
of two values, so it is monotone.

Scale. Rows are sorted by ranges of (conv_id, turn, role, text), so that a conversation of any size spreads over partitions;
what lies whole inside a partition is repaired in that pass, row after row. The first and last conversation of a partition may
go on in another: their rows are cut in segments of ``SEGMENT`` rows or ``BYTES`` of text. Repeated rows are found by
the first place of each (role, text), pre-aggregated. A segment is a weighted deduction of its own: for each pair (p, q) the
lightest derivation that leads from p in front of it to q behind it, by the same agenda. A conversation's segments are chained
from the last to the first; four values are kept, as lists that share their tails. The result of a conversation is one row with its whole audit and
one sha256 of its whole repaired text, so that chain and the digest of one conversation, which reads its repaired text piece
by piece, each take one task; nothing else does.

Cases: a null conv_id is a conversation; null role and text are one space. Blank texts have nothing but white space. A
conversation without rows has zeros, no audit and the hash of the empty string. Roles of other initials than s, u, a cannot
be kept. Repeated rows are duplicates. Other columns are not read; the table may be empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain, groupby, islice
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
SOUND, BLANK, DUPLICATE, CUT = 0, 1, 2, 3
SEGMENT = 512
BYTES = 1 << 22
# what stands in front: nothing, s, u or a; and what may follow it
NOTHING, S, U, A = range(4)
FOLLOWS = {(NOTHING, "s"): S, (NOTHING, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
LAST = (NOTHING, A)
ROLES = {"u": "user", "a": "assistant"}
ILLEGAL_BUT = ("su", "ua", "au")


# ---- the agenda ---------------------------------------------------------------------

def lightest(rows: tuple[tuple[str, int], ...], ends: tuple[int, ...], goals: tuple[int, ...]) -> dict[int, tuple[int, str]]:
    """(cost, audit) of the lightest derivation of each goal, that is of what may stand in front of ``rows`` (initial and
    fault of each), such that one of ``ends`` stands behind them. Goals that cannot be reached are left out."""
    count = len(rows)
    agenda = [(0, 0, "", end) for end in ends]
    final: set[tuple[int, int]] = set()
    found: dict[int, tuple[int, str]] = {}
    while agenda:
        cost, behind, audit, state = heappop(agenda)
        if (behind, state) in final:
            continue
        final.add((behind, state))
        if behind == count and state in goals:
            found[state] = (cost, audit)
            if len(found) == len(goals):
                break
        for (front, role), after in FOLLOWS.items():
            if after == state and role != "s" and (behind, front) not in final:
                heappush(agenda, (cost + INSERT, behind, "I" + audit, front))
        if behind == count:
            continue
        initial, fault = rows[count - 1 - behind]
        heappush(agenda, (cost + DELETE, behind + 1, "D" + audit, state))
        if fault in (SOUND, CUT):
            more = cost + (TRUNCATED if fault == CUT else 0)
            for (front, role), after in FOLLOWS.items():
                if after == state:
                    if role == initial:
                        heappush(agenda, (more + KEEP, behind + 1, "K" + audit, front))
                    if role != "s":
                        heappush(agenda, (more + REROLE, behind + 1, "R" + audit, front))
    return found


@lru_cache(maxsize=1 << 15)
def _repair_of(shape: str) -> tuple[int, str]:
    return lightest(tuple((shape[i], int(shape[i + 1])) for i in range(0, len(shape), 2)), LAST, (NOTHING,))[NOTHING]


def repair(rows: list[tuple[str, int]]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of a whole conversation; those of one shape are repaired once."""
    return _repair_of("".join(f"{initial if initial in ('s', 'u', 'a') else '-'}{fault}" for initial, fault in rows))


def repaired(rows: list[tuple[str, str]], audit: str, front: int = NOTHING) -> Iterator[str]:
    """The repaired ``role:text`` lines of rows (role, text) by their edits."""
    source = iter(rows)
    for edit in audit:
        wanted = "a" if front == U else "u"
        if edit == "I":
            front = FOLLOWS[front, wanted]
            yield f"{ROLES[wanted]}:"
            continue
        role, text = next(source)
        if edit == "R":
            role = ROLES[wanted]
        if edit != "D":
            front = FOLLOWS[front, role[:1]]
            yield f"{role}:{text}"


def illegal_pairs(initials: list[str]) -> int:
    return sum(a + b not in ILLEGAL_BUT for a, b in zip(initials, initials[1:]))


# ---- damage ---------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and present; a dropped row stays as one that is not present."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
    there = F.col("kind") != 0
    return (rows.withColumn("copy", F.explode(copies))
            .select("conv_id", F.when(there, F.col("turn")).alias("turn"),
                    F.when(~there, "").when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(there, text).otherwise("").alias("text"), there.alias("present")))


def faults() -> Column:
    """Fault of a row by its own text; duplicates are found later."""
    white = r"\x20\x09-\x0D"
    return (F.when(~F.col("text").rlike(f"[^{white}]"), BLANK)
            .when(F.col("text").rlike(rf"[.!?][{white}]*\z"), SOUND).otherwise(CUT))


# ---- whole conversations and the rows of others -------------------------------------------

class Row(NamedTuple):
    turn: int | None
    role: str
    text: str
    present: bool
    fault: int


_RESULT = ("conv_id {0}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
           "repaired_sha256 string")
_OPEN = "turn long, role string, text string, present boolean, fault int, part int, at long, segment long"


def _gaps(turns: list[int]) -> int:
    return turns[-1] - turns[0] + 1 - len(set(turns)) if turns else 0


def whole(rows: list[Row]) -> tuple:
    """What the result says of a conversation."""
    rows = [row for row in rows if row.present]
    seen: set[tuple[str, str]] = set()
    found = [0, 0, 0, 0]
    kinds = []
    for row in rows:
        again = (row.role, row.text) in seen
        seen.add((row.role, row.text))
        fault = DUPLICATE if again and row.fault != BLANK else row.fault
        found[fault] += 1
        kinds.append((row.role[:1], fault))
    cost, audit = repair(kinds)
    digest = hashlib.sha256("\n".join(repaired([(r.role, r.text) for r in rows], audit)).encode()).hexdigest()
    return (_gaps([r.turn for r in rows if r.turn is not None]), *found[1:], illegal_pairs([k[0] for k in kinds]), cost, audit, digest)


def _rows(batches: Iterator[pa.RecordBatch], types: list[pa.DataType]) -> Iterator[tuple]:
    """Rows of all batches; the type of the first column is put into ``types``."""
    for batch in batches:
        types[:] = [batch.schema.field(0).type]
        yield from zip(*(column.to_pylist() for column in batch.columns))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's ordered rows: a result row of each conversation of up to ``SEGMENT`` rows that lies inside, and the
    rows of the first, the last and of longer ones with their segments."""
    part, at, segment, rows_in, bytes_in = TaskContext.get().partitionId(), 0, 0, 0, 0
    types: list[pa.DataType] = []

    def opened(conv, row: Row) -> tuple:
        nonlocal at, segment, rows_in, bytes_in
        if rows_in >= SEGMENT or bytes_in >= BYTES:
            segment, rows_in, bytes_in = segment + 1, 0, 0
        at, rows_in, bytes_in = at + 1, rows_in + 1, bytes_in + len(row.text)
        return (conv, *[None] * 8, *row, part, at, segment)

    def found() -> Iterator[tuple]:
        held = None
        for number, (conv, rows) in enumerate(groupby(_rows(batches, types), key=lambda row: row[0])):
            if held:
                yield (held[0], *whole(held[1]), *[None] * 8)
            held = (conv, [Row(*row[1:]) for row in islice(rows, SEGMENT if number else 0)])
            rest = next(rows, None)
            if rest:
                for row in chain(held[1], (Row(*row[1:]) for row in chain([rest], rows))):
                    yield opened(conv, row)
                held = None
        if held:
            for row in held[1]:
                yield opened(held[0], row)

    out: list[tuple] = []
    size = 0
    for row in found():
        out.append(row)
        size += len(row[_TEXT] or "") + 200
        if size > BYTES:
            yield _scanned(out, types[0])
            out, size = [], 0
    if out:
        yield _scanned(out, types[0])


_SCAN_NAMES = [field.split()[0] for field in f"{_RESULT}, {_OPEN}".split(", ")]
_SCAN_TYPES = [*[pa.int64()] * 6, pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
_TEXT = _SCAN_NAMES.index("text")


def _scanned(rows: list[tuple], conv_type: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), [conv_type, *_SCAN_TYPES])], _SCAN_NAMES)


# ---- conversations that may span partitions --------------------------------------------------

def _segments(table: pa.Table) -> pa.Table:
    """One row of a segment's rows (without text): counts, the initials and turns at its ends, and a derivation of each pair
    of what stands in front and behind."""
    rows = sorted(zip(*(table[c].to_pylist() for c in ("at", "turn", "initial", "fault", "present"))))
    rows = [row for row in rows if row[4]]
    kinds = tuple((row[2], row[3]) for row in rows)
    turns = [row[1] for row in rows if row[1] is not None]
    costs, audits = [], []
    for end in range(4):
        found = lightest(kinds, (end,), (NOTHING, S, U, A))
        for front in range(4):
            cost, audit = found.get(front, (-1, ""))
            costs.append(cost)
            audits.append(audit)
    faults_seen = [sum(k[1] == fault for k in kinds) for fault in (BLANK, DUPLICATE, CUT)]
    values = [table["conv_id"][0].as_py(), table["part"][0].as_py(), table["segment"][0].as_py(), len(rows), *faults_seen,
              illegal_pairs([k[0] for k in kinds]), kinds[0][0] if kinds else None, kinds[-1][0] if kinds else None,
              turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)), costs, audits]
    return pa.Table.from_arrays([pa.array([v], kind) for v, kind in zip(values, [table.schema.field("conv_id").type, *_SEGMENT_TYPES])], _SEGMENT_NAMES)


_SEGMENT = ("conv_id {0}, part int, segment long, rows long, blank long, duplicate long, truncated long, illegal long, "
            "first_initial string, last_initial string, first_turn long, last_turn long, turns long, costs array<long>, audits array<string>")
_SEGMENT_NAMES = [field.split()[0] for field in _SEGMENT.split(", ")]
_SEGMENT_TYPES = [pa.int32(), pa.int64(), *[pa.int64()] * 5, pa.string(), pa.string(), *[pa.int64()] * 3, pa.list_(pa.int64()), pa.list_(pa.string())]


class Tail(NamedTuple):
    """The edits of a segment and of those behind it."""

    audit: str
    state: int  # what stands behind the segment
    rest: "Tail | None"


def _letters(tail: Tail | None) -> Iterator[str]:
    while tail is not None:
        yield from tail.audit
        tail = tail.rest


def _less(one: Tail, other: Tail) -> bool:
    """Whether an audit of the same cost comes first; they differ within a few letters of the segment or are the same."""
    for a, b in zip(_letters(one), _letters(other)):
        if a != b:
            return a < b
    return False


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the segments of each conversation, last to first: a row of the conversation (segment null) and one row a segment
    with what stands in front of it and its edits."""
    types: list[pa.DataType] = []
    for conv, segments in groupby(_rows(batches, types), key=lambda row: row[0]):
        best: dict[int, tuple[int, Tail | None]] = {end: (0, None) for end in LAST}
        places = []
        blank = duplicate = truncated = illegal = turns = 0
        first_turn = last_turn = behind_initial = behind_turn = None
        for row in segments:
            row = dict(zip(_SEGMENT_NAMES, row))
            places.append((row["part"], row["segment"]))
            blank, duplicate, truncated = blank + row["blank"], duplicate + row["duplicate"], truncated + row["truncated"]
            illegal += row["illegal"]
            if row["rows"]:
                if behind_initial is not None and row["last_initial"] + behind_initial not in ILLEGAL_BUT:
                    illegal += 1
                behind_initial = row["first_initial"]
            if row["turns"]:
                turns += row["turns"] - (behind_turn is not None and behind_turn == row["last_turn"])
                behind_turn = first_turn = row["first_turn"]
                last_turn = row["last_turn"] if last_turn is None else last_turn
            new: dict[int, tuple[int, Tail | None]] = {}
            for end, (cost, rest) in best.items():
                for front in range(4):
                    own = row["costs"][4 * end + front]
                    if own < 0:
                        continue
                    tail = Tail(row["audits"][4 * end + front], end, rest)
                    had = new.get(front)
                    if had is None or cost + own < had[0] or (cost + own == had[0] and _less(tail, had[1])):
                        new[front] = (cost + own, tail)
            best = new
        cost, tail = best[NOTHING]
        gaps = last_turn - first_turn + 1 - turns if turns else 0
        audit = []
        state, pieces = NOTHING, []
        for part, segment in reversed(places):
            audit.append(tail.audit)
            pieces.append((conv, part, segment, state, tail.audit, *[None] * 6))
            state, tail = tail.state, tail.rest
        rows = [*pieces, (conv, None, None, None, "".join(audit), gaps, blank, duplicate, truncated, illegal, cost)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows), [types[0], pa.int32(), pa.int64(), pa.int32(), pa.string(), *[pa.int64()] * 6])], _CHAIN_NAMES)


_CHAIN = "conv_id {0}, part int, segment long, front int, audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
_CHAIN_NAMES = [field.split()[0] for field in _CHAIN.split(", ")]


def _piece(rows: pa.Table, edits: pa.Table) -> pa.Table:
    """The repaired lines of a segment."""
    own = sorted(zip(*(rows[c].to_pylist() for c in ("at", "present", "role", "text"))))
    lines = list(repaired([(r[2], r[3]) for r in own if r[1]], edits["audit"][0].as_py(), edits["front"][0].as_py()))
    return pa.Table.from_arrays(
        [rows["conv_id"].slice(0, 1), rows["part"].slice(0, 1), rows["segment"].slice(0, 1), pa.array([len(lines)], pa.int64()),
         pa.array(["\n".join(lines)])], ["conv_id", "part", "segment", "lines", "text"])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """conv_id and sha256 of ordered pieces of text, joined by newlines."""
    types: list[pa.DataType] = []
    for conv, pieces in groupby(_rows(batches, types), key=lambda row: row[0]):
        digest, some = hashlib.sha256(), False
        for _, lines, text in pieces:
            if lines:
                digest.update((b"\n" if some else b"") + text.encode())
                some = True
        yield pa.RecordBatch.from_arrays([pa.array([conv], types[0]), pa.array([digest.hexdigest()])], ["conv_id", "repaired_sha256"])


def _spanning(rows: DataFrame) -> DataFrame:
    """Results of the conversations whose ``rows`` (with part, at and segment) may lie in several partitions."""
    kind = dict(rows.dtypes)["conv_id"]
    place = F.struct("part", "at")
    hashed = rows.withColumn("same", F.struct(F.xxhash64("role", "text").alias("one"), F.xxhash64(F.lit(1), "text", "role").alias("two")))
    first = hashed.filter("present").groupBy(F.col("conv_id").alias("conv"), F.col("same").alias("of")).agg(F.min(place).alias("first"))
    slim = hashed.drop("text").withColumn("initial", F.substring("role", 1, 1))
    fault = F.when((F.col("fault") != BLANK) & (F.col("first") != place), DUPLICATE).otherwise(F.col("fault"))
    marked = (slim.join(first, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("same") == F.col("of")), "left")
              .select("conv_id", "part", "segment", "at", "turn", "initial", fault.alias("fault"), "present"))
    segments = stored(marked.groupBy("conv_id", "part", "segment").applyInArrow(_segments, _SEGMENT.format(kind)), "conversation_segments")
    order = [F.desc("part"), F.desc("segment")]
    chain = stored(segments.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *order)
                   .mapInArrow(_chained, _CHAIN.format(kind)), "conversation_chain")
    keys = ["conv_id", "part", "segment"]
    pieces = (rows.select(*keys, "at", "present", "role", "text").groupBy(*keys)
              .cogroup(chain.filter("segment IS NOT NULL").select(*keys, "front", "audit").groupBy(*keys))
              .applyInArrow(_piece, f"conv_id {kind}, part int, segment long, lines long, text string"))
    digests = (pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "segment").select("conv_id", "lines", "text")
               .mapInArrow(_digest, f"conv_id {kind}, repaired_sha256 string").withColumnRenamed("conv_id", "of"))
    totals = chain.filter("segment IS NULL")
    return (totals.join(digests, F.col("conv_id").eqNullSafe(F.col("of")))
            .select(_SCAN_NAMES[:9]))


def repaired_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of every conversation of ``rows``
    (conv_id, turn, role, text, present)."""
    kind = dict(rows.dtypes)["conv_id"]
    order = [F.asc_nulls_first(c) for c in ("conv_id", "turn", "role", "text")]
    sorted_rows = (rows.withColumn("fault", faults()).select("conv_id", "turn", "role", "text", "present", "fault")
                   .repartitionByRange(*order).sortWithinPartitions(*order))
    scanned = stored(sorted_rows.mapInArrow(_scan, ", ".join((_RESULT.format(kind), _OPEN))), "conversations")
    inside = scanned.filter("part IS NULL").select(_SCAN_NAMES[:9])
    spanning = scanned.filter("part IS NOT NULL").select("conv_id", *_SCAN_NAMES[9:])
    return inside.unionAll(_spanning(spanning))


def op13_conversations(conversations: DataFrame) -> DataFrame:
    return repaired_conversations(damaged(conversations))
