"""Benchmark decontamination by winnowing.

Words are hashed in grams of ``GRAM``; of every ``SPAN`` consecutive grams the smallest hash is kept (the last one on a
tie). Any shared run of ``GRAM + SPAN - 1`` = ``WINDOW`` words therefore keeps the same gram on both sides, at the same
place of the run: no shared window is missed. Documents and benchmark meet by a join on these fingerprints; each joined
pair is extended over all windows around its gram and compared word for word, so hashes decide nothing.

Benchmark items shorter than a window are windows themselves: their only fingerprint is the gram of all their words, and
documents get the grams of just those lengths.

Before the join, documents drop fingerprints whose slot is empty in a bitmap of the benchmark's fingerprints. Its size is
fixed (``SLOTS`` bits, half a megabyte, whatever the benchmark's size); a fuller bitmap lets more rows through to the join
and changes no result.

Cases: a null or empty text has no words, is not contaminated, and as an item is no window. Rows that repeat a document
(same doc_id, same text) are one row of the result; rows of one doc_id with different texts stay apart. A null doc_id is
kept. Other columns are neither read nor returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, map_batches, stored
from tidemark.llm.words import ALNUM, Words, each_piece, grams, mix, signed

WINDOW = 10
GRAM, SPAN = 5, 6
SLOTS = 1 << 22


def winnow(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Kept fingerprints of each text and the word each gram begins with."""
    value, at = grams(words, GRAM)
    if not len(value):
        return value, at
    text = words.text[at]
    # windows of SPAN grams lie within one text; grams of a text are consecutive
    count = len(value) - SPAN + 1
    if count <= 0:
        return value[:0], at[:0]
    low, best = value[:count].copy(), np.arange(count)
    for i in range(1, SPAN):
        take = value[i:count + i] <= low
        low = np.where(take, value[i:count + i], low)
        best = np.where(take, np.arange(i, count + i), best)
    kept = np.unique(best[text[:count] == text[SPAN - 1:]])
    return value[kept], at[kept]


def short_grams(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    value, at = grams(words, size)
    return mix(value ^ np.uint64(size)), at


def context(words: Words, at: int, size: int) -> tuple[list[str], int]:
    """The words of all windows around a gram, and the gram's place among them."""
    text = words.text[at]
    low = max(int(words.first[text]), at - (WINDOW - GRAM)) if size == WINDOW else at
    high = min(int(words.first[text + 1]), at + WINDOW) if size == WINDOW else at + size
    return [words.string(i) for i in range(low, high)], at - low


ITEM_SCHEMA = "item_id string, size int, fp long, item_words array<string>, item_at int"


def item_fingerprints(benchmark: DataFrame) -> DataFrame:
    """Fingerprints of benchmark items with the words around them."""

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for low, _, words in each_piece(batch.column(1), ALNUM):
            count = np.diff(words.first)
            found = [(WINDOW, *winnow(words))]
            found += [(int(n), *short_grams(words, int(n))) for n in np.unique(count[(count > 0) & (count < WINDOW)])]
            for size, value, at in found:
                for fp, place in zip(signed(value).tolist(), at.tolist()):
                    text = int(words.text[place])
                    if size == WINDOW or count[text] == size:
                        around, own = context(words, place, size)
                        out.append((batch.column(0)[low + text].as_py(), size, fp, around, own))
        names = ("item_id", "size", "fp", "item_words", "item_at")
        types = (pa.string(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int32())
        columns = list(zip(*out)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    source = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")
    return map_batches(source, work, ITEM_SCHEMA)


def bitmap(fingerprints: DataFrame) -> np.ndarray:
    """Bits of the slots that fingerprints fall in; at most ``SLOTS`` numbers come to the driver."""
    slots = fingerprints.select(F.expr(f"int(fp & {SLOTS - 1})").alias("slot")).distinct().toArrow()
    bits = np.zeros(SLOTS // 8, dtype=np.uint8)
    at = slots.column(0).to_numpy()
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits


# behind doc_id, which keeps its type
DOCUMENT_SCHEMA = ("doc_key long, n_words long, size int, fp long, "
                   "doc_words array<string>, doc_at int, word int")


def document_fingerprints(documents: DataFrame, bits: np.ndarray, short: list[int]) -> DataFrame:
    """A row for each document, and one for each fingerprint that the bitmap knows."""
    shared = documents.sparkSession.sparkContext.broadcast(bits)

    def known(value: np.ndarray) -> np.ndarray:
        slot = value & np.uint64(SLOTS - 1)
        byte = shared.value[(slot >> np.uint64(3)).astype(np.int64)]
        return np.flatnonzero((byte >> (slot & np.uint64(7)).astype(np.uint8)) & 1)

    def work(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for low, high, words in each_piece(batch.column(2), ALNUM):
            row, size, fp, around, own, place = [], [], [], [], [], []
            for n, (value, at) in [(WINDOW, winnow(words)), *((n, short_grams(words, n)) for n in short)]:
                kept = known(value)
                for hash_, word in zip(signed(value[kept]).tolist(), at[kept].tolist()):
                    text = int(words.text[word])
                    found, offset = context(words, word, n)
                    row.append(text), size.append(n), fp.append(hash_)
                    around.append(found), own.append(offset), place.append(word - int(words.first[text]))
            rows = np.concatenate((np.arange(high - low), np.array(row, dtype=np.int64)))
            blank = [None] * (high - low)
            picked = pa.array(rows + low)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(picked), batch.column(1).take(picked),
                pa.array(np.diff(words.first)[rows], pa.int64()), pa.array(blank + size, pa.int32()),
                pa.array(blank + fp, pa.int64()), pa.array(blank + around, pa.list_(pa.string())),
                pa.array(blank + own, pa.int32()), pa.array(blank + place, pa.int32()),
            ], ["doc_id", "doc_key", "n_words", "size", "fp", "doc_words", "doc_at", "word"])

    source = documents.select("doc_id", F.xxhash64("text").alias("doc_key"), "text")
    return map_batches(source, work, f"doc_id {dict(source.dtypes)['doc_id']}, {DOCUMENT_SCHEMA}")


# Starts, relative to the gram, of the windows in which both sides agree word for word.
_EXTENDED = f"""
    CASE WHEN size = {WINDOW} THEN filter(sequence(-{WINDOW - GRAM}, 0), s ->
            doc_at + s >= 0 AND item_at + s >= 0
            AND doc_at + s + {WINDOW} <= size(doc_words) AND item_at + s + {WINDOW} <= size(item_words)
            AND slice(doc_words, doc_at + s + 1, {WINDOW}) = slice(item_words, item_at + s + 1, {WINDOW}))
         WHEN doc_words = item_words THEN array(0) END"""

# Words covered by sorted ranges: each adds what lies beyond the end reached so far.
_COVERED = """aggregate(array_sort(collect_set(range)), struct(0L AS n, 0 AS upto),
    (a, r) -> struct(a.n + greatest(0, r.start + r.size - greatest(a.upto, r.start)) AS n,
                     greatest(a.upto, r.start + r.size) AS upto), a -> a.n)"""


def contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, doc_key (hash of the text), n_words, n_hit (words inside shared windows) and items (sorted ids)."""
    items = item_fingerprints(benchmark)
    short = [row["size"] for row in items.select("size").distinct().collect() if row["size"] < WINDOW]
    found = document_fingerprints(documents, bitmap(items), short)
    # rows without a fingerprint get a key of their own, so that they do not meet in one task
    found = found.withColumn("join_key", F.coalesce("fp", F.xxhash64("doc_id", "doc_key")))
    joined = (found.join(items.withColumnRenamed("fp", "join_key"), ["join_key", "size"], "left")
              .withColumn("starts", F.expr(_EXTENDED)))
    ranges = joined.select(
        "doc_id", "doc_key", "n_words",
        F.when(F.size("starts") > 0, F.col("item_id")).alias("item_id"),
        F.explode_outer("starts").alias("s"), "word", "size")
    ranges = ranges.withColumn("range", F.when(
        F.col("s").isNotNull(), F.struct((F.col("word") + F.col("s")).alias("start"), "size")))
    return ranges.groupBy("doc_id", "doc_key").agg(
        F.max("n_words").alias("n_words"), F.expr(_COVERED).alias("n_hit"),
        F.array_sort(F.collect_set("item_id")).alias("items"))


def clean(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a shared window, with their columns.

    Null and empty texts share nothing and stay, repeated rows stay or go together, a null doc_id is an id like any other, and
    columns may have any names.
    """
    key = free_name(documents, "_text_key")
    hit = contaminated(documents, benchmark).filter("n_hit > 0").select(F.col("doc_id").alias("hit_id"), "doc_key")
    hit = stored(hit, "contaminated")
    rows = documents.withColumn(key, F.xxhash64("text"))
    return rows.join(hit, rows["doc_id"].eqNullSafe(hit["hit_id"]) & (rows[key] == hit["doc_key"]), "left_anti").drop(key)


def op2_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(documents, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
