"""Token ids in files: frequency-ranked ids, each in one to four bytes, with the lengths in control bytes of their own.

Writing. Texts are tokenised once and their ids kept in a scratch table with the count of every id. The most frequent id
has rank 0, the next rank 1 (equal counts by id), so that the frequent ids take one byte. The documents are dealt by ranges of
(doc_id, hash of the text, row of the scratch table), sorted, and packed into blocks of about ``BLOCK`` ids of whole
documents. A block has a control stream, two bits an id for its number of bytes, four ids a byte, and a data stream of the
ranks' bytes, lowest first.

Format. ``path/blocks`` is a Parquet table, a row a block: part and block (ascending doc_id is ascending part, block, place
in the block), first (ids of the part before the block), doc_ids and sizes (of each document, ids), control and data (both
streams, each document from a byte of its own). ``path/ranks`` has rank, id and count. Spark commits both, so a lost
executor or a second attempt of a task leaves no part of a file behind.

Reading. The lengths of four ids come from a table of 256 control bytes at once, their sums place every id in the data
stream, and a table of the ranks gives the ids.

Tokenising. The tokenizer drops white space and none of its pieces spans any, so the ids of a text are those of its runs
between ASCII white space, one after the other. Arrow cuts a chunk of texts into runs, numbers the distinct ones and puts their ids
in the texts' places; Python looks at each distinct run of a chunk once. A worker keeps the ids of the runs and pieces it met last,
twice ``KNOWN`` of either at most. The file of the tokenizer is read by the driver and sent to the workers, whose own disks need not have it. For a tokenizer that does not
drop white space (``spaced=False``) whole texts are given to it.

Cases: a null or empty text has the end id alone. Rows that repeat a doc_id are documents of their own, ordered by a hash of
the text; equal rows are interchangeable. A null doc_id comes first. A table without rows gives files without blocks. Other
columns are not read. One document is coded in one task, whatever its length.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain, compress, filterfalse, pairwise
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import drop_stored, map_batches, stored
from tidemark.session import scratch_path

END = 1
BLOCK = 1 << 17
KNOWN = 1 << 19
CHUNK = 1 << 23  # bytes of text that are tokenised at once, a longer text alone

# number of bytes of the four ids of a control byte
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


# ---- the code ----------------------------------------------------------------

def encode(ranks: np.ndarray, sizes: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data stream of the unsigned 32-bit ranks of consecutive documents of ``sizes`` ids, each of which begins
    with a control byte of its own."""
    ranks, sizes = ranks.astype(np.uint32), np.asarray(sizes, dtype=np.int64)
    length = 1 + (ranks >= 1 << 8).astype(np.int64) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    place = np.cumsum(length) - length
    data = np.empty(int(length.sum()), dtype=np.uint8)
    for byte in range(4):
        has = length > byte
        data[place[has] + byte] = (ranks[has] >> np.uint32(8 * byte)) & np.uint32(255)
    room = -(-sizes // 4) * 4
    slots = np.zeros(int(room.sum()), dtype=np.uint8)
    slots[np.arange(len(ranks)) + np.repeat(np.cumsum(room - sizes) - (room - sizes), sizes)] = length - 1
    four = slots.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    return control.astype(np.uint8).tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, sizes: np.ndarray) -> np.ndarray:
    """Ranks of consecutive documents of ``sizes`` ids, each of which begins with a control byte of its own."""
    sizes = np.asarray(sizes, dtype=np.int64)
    length = LENGTHS[np.frombuffer(control, dtype=np.uint8)].reshape(-1)
    slots = -(-sizes // 4) * 4
    # places of the control stream that hold no id
    inside = np.arange(len(length)) - np.repeat(np.cumsum(slots) - slots, slots) < np.repeat(sizes, slots)
    length = length[inside].astype(np.int64)
    place = np.cumsum(length) - length
    raw = np.frombuffer(data, dtype=np.uint8)
    ranks = np.zeros(len(length), dtype=np.uint32)
    for byte in range(4):
        has = np.flatnonzero(length > byte)
        ranks[has] |= raw[place[has] + byte].astype(np.uint32) << np.uint32(8 * byte)
    return ranks


# ---- tokenising --------------------------------------------------------------

class Kept:
    """The ids of the keys that were asked for lately, twice ``KNOWN`` at most (or twice those of a call)."""

    def __init__(self):
        self.fresh: dict = {}
        self.old: dict = {}

    def known(self, keys: list) -> list:
        """The ids of ``keys``, None where there are none yet. Those found are fresh then, and remain so until the next call."""
        if len(self.fresh) + len(keys) > KNOWN:
            self.old, self.fresh = self.fresh, {}
        found = list(map(self.fresh.get, keys))
        if self.old:
            for at in [at for at, ids in enumerate(found) if ids is None]:
                ids = self.old.get(keys[at])
                if ids is not None:
                    found[at] = self.fresh[keys[at]] = ids
        return found


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library, as bytes of little-endian unsigned integers of ``width`` bytes.

    The ids of a run between white space are those of its pieces, and a worker keeps the ids of the runs and pieces it has
    seen. Where the file cuts texts by a pattern and lower-cases them, runs of letters that it would only lower-case (ASCII and
    the letters of Latin-1) are cut here by its own pattern, so that only new pieces go through the merges; all other runs go
    through the whole tokenizer.
    """

    def __init__(self, model: str, spaced: bool, width: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.spaced, self.kind = Tokenizer.from_str(model), spaced, f"<u{width}"
        self.runs, self.pieces = Kept(), Kept()
        self.cut = self.plain = None
        told = json.loads(model)
        if [step["type"] for step in (told["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]:
            steps = (told["pre_tokenizer"] or {}).get("pretokenizers", [])
            if ([step["type"] for step in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
                    and not steps[1]["add_prefix_space"] and not steps[1].get("use_regex", True)):
                # of runs in lines
                self.cut = regex.compile(rf"(?:{steps[0]['pattern']['Regex']})|\n").findall
                # ASCII without white space and control characters, and letters of Latin-1; no added token can begin in it
                first = {token["content"][:1] for token in told["added_tokens"]}
                plain = [*map(chr, range(0x21, 0x7F)), *(chr(c) for c in range(0xC0, 0x100) if chr(c).isalpha())]
                self.plain = regex.compile(r"[\n" + "".join(regex.escape(c) for c in plain if c not in first) + "]+").fullmatch
                self.merges = self.tokenizer.model.tokenize
                self.spelled = Tokenizer.from_str(json.dumps(told | {"pre_tokenizer": steps[1]})).pre_tokenizer.pre_tokenize_str
                (self.line, _), = self.spelled("\n")
                by_line = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Removed", "invert": False}
                self.lines = Tokenizer.from_str(json.dumps(told | {
                    "normalizer": None, "truncation": None, "padding": None,
                    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [by_line, steps[1]]}}))
                self.suffix = told["model"].get("end_of_word_suffix")
                vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
                self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
                if self.suffix:
                    self.last[[at for word, at in vocabulary.items() if word.endswith(self.suffix)]] = True

    def packed(self, found: list[list[int]]) -> list[bytes]:
        flat = np.fromiter(chain.from_iterable(found), dtype=self.kind).tobytes()
        ends = np.cumsum([0, *map(len, found)]) * np.dtype(self.kind).itemsize
        return [flat[low:high] for low, high in pairwise(ends.tolist())]

    def encoded(self, texts: list[str]) -> list[bytes]:
        return self.packed([e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)])

    def merged(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, none of which holds a line end.

        All at once, and cut behind every token of a word's end. Where the text could spell that suffix, or a piece has no
        such token: their bytes as characters, then the merges of each.
        """
        text = "\n".join(pieces)
        if self.suffix and self.suffix not in text:
            ids = np.array(self.lines.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.kind)
            ends = (np.flatnonzero(self.last[ids]) + 1) * ids.itemsize
            if len(ends) == len(pieces) and ends[-1] == ids.nbytes:
                flat = ids.tobytes()
                return [flat[low:high] for low, high in pairwise([0, *ends.tolist()])]
        (text, _), = self.spelled(text)
        return self.packed([[token.id for token in self.merges(piece)] for piece in text.split(self.line)])

    def learn(self, runs: list[str]) -> None:
        """Puts the ids of new runs into ``runs``."""
        kept, whole = self.runs.fresh, []
        if not self.plain:
            runs, whole = [], runs
        text = "\n".join(runs)
        if text and not self.plain(text):
            whole = [run for run in runs if not self.plain(run)]
            runs = list(set(runs).difference(whole))
            text = "\n".join(runs)
        if whole:
            kept.update(zip(whole, self.encoded(whole)))
        if not runs:
            return
        lines = text.lower().split("\n")
        single = list(map(str.isalpha, lines))
        mixed = list(filterfalse(str.isalpha, lines))
        pieces = self.cut("\n".join(mixed)) if mixed else []
        alone = list(compress(lines, single))
        asked = set(alone).union(pieces)
        asked.discard("\n")
        asked = list(asked)
        new = [piece for piece, ids in zip(asked, self.pieces.known(asked)) if ids is None]
        known = self.pieces.fresh
        if new:
            known.update(zip(new, self.merged(new)))
        kept.update(zip(compress(runs, single), map(known.__getitem__, alone)))
        if mixed:
            ids = [known.get(piece) for piece in pieces]  # none for a line end
            ends = [at for at, piece in enumerate(pieces) if piece == "\n"]
            of = [b"".join(ids[low + 1:high]) for low, high in pairwise([-1, *ends, len(pieces)])]
            kept.update(zip(compress(runs, map(not_, single)), of))

    def coded(self, texts: pa.Array) -> pa.Array:
        """Ids of an array of texts without nulls."""
        if not self.spaced:
            return pa.array(self.encoded(texts.to_pylist()), pa.binary())
        # cuts at ASCII white space only; white space at an end of a text makes an empty run, which has no ids
        cut = pc.ascii_split_whitespace(texts)
        runs = cut.values.dictionary_encode()
        distinct = runs.dictionary.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist
        found = self.runs.known(distinct)
        gaps = [at for at, ids in enumerate(found) if ids is None]
        if gaps:
            self.learn([distinct[at] for at in gaps])
            for at in gaps:
                found[at] = self.runs.fresh[distinct[at]]
        placed = pa.array(found, pa.binary()).take(runs.indices)
        # the ids of a text's runs lie one behind the other
        ends = np.frombuffer(placed.buffers()[1], dtype=np.int32)[cut.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(ends), placed.buffers()[2]])

    def ids(self, texts: list[str]) -> list[bytes]:
        return self.coded(pa.array(texts, pa.string())).to_pylist()


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(model: str, spaced: bool, width: int) -> Encoder:
    """The worker's encoder, kept from task to task."""
    key = (zlib.crc32(model.encode()), spaced, width)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model, spaced, width)
    return _ENCODERS[key]


def bytes_of_id(model: str, end: int) -> int:
    """Bytes of the ids of a tokenizer and of the end id as they are kept until they are coded."""
    from tokenizers import Tokenizer

    return 2 if max(Tokenizer.from_str(model).get_vocab_size(), end + 1) <= 1 << 16 else 4


def tokenised(documents: DataFrame, model: str, width: int, end: int = END, spaced: bool = True) -> DataFrame:
    """doc_id, key (hash of the text), ids (unsigned, of ``width`` bytes, the end id last) and counts (null but for the last
    row of a task, which has no document: pairs of id and count)."""
    shared = documents.sparkSession.sparkContext.broadcast(model)  # as large as the tokenizer's file
    kind = f"<u{width}"
    last, nothing = pa.scalar(np.array([end], dtype=kind).tobytes()), pa.scalar(b"")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(shared.value, spaced, width)
        counts = np.zeros(0, dtype=np.int64)
        id_type = None
        for batch in batches:
            id_type = batch.column(0).type
            size = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_pylist()
            low = 0
            while low < batch.num_rows:
                high, total = low, 0
                while high < batch.num_rows and (high == low or total + size[high] <= CHUNK):
                    total += size[high]
                    high += 1
                texts = pc.fill_null(batch.column(2).slice(low, high - low), "")
                ids = pc.binary_join_element_wise(own.coded(texts), last, nothing)
                total = int(pc.sum(pc.binary_length(ids)).as_py())
                seen = np.bincount(np.frombuffer(ids.buffers()[2], dtype=kind, count=total // width), minlength=len(counts))
                seen[:len(counts)] += counts
                counts = seen
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), ids,
                     pa.nulls(high - low, pa.binary())], ["doc_id", "key", "ids", "counts"])
                low = high
        if id_type is not None:
            used = np.flatnonzero(counts)
            pairs = np.stack((used, counts[used]), axis=1).astype("<i8").tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([pairs], pa.binary())],
                ["doc_id", "key", "ids", "counts"])

    source = documents.select("doc_id", F.xxhash64("text").alias("key"), "text")
    return source.mapInArrow(work, f"doc_id {dict(source.dtypes)['doc_id']}, key long, ids binary, counts binary")


def counted(tokens: DataFrame) -> DataFrame:
    """id and count over all documents."""
    def work(batch: pa.RecordBatch):
        pairs = np.frombuffer(b"".join(batch.column(0).to_pylist()), dtype="<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["id", "count"])

    found = map_batches(tokens.filter("counts IS NOT NULL").select("counts"), work, "id long, count long")
    return found.groupBy("id").agg(F.sum("count").alias("count"))


# ---- files -------------------------------------------------------------------

def write_token_files(documents: DataFrame, path: str, tokenizer: str, end: int = END, spaced: bool = True) -> None:
    """The token files of all documents below ``path``."""
    spark = documents.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        model = file.read()
    width = bytes_of_id(model, end)
    tokens = stored(tokenised(documents, model, width, end, spaced).withColumn("row", F.monotonically_increasing_id()), "token_ids", "zstd")
    # a row an id of the vocabulary at most
    counts = counted(tokens).toArrow()
    ids, count = counts["id"].to_numpy(), counts["count"].to_numpy()
    order = np.lexsort((ids, -count))
    ranks = pa.table({"rank": pa.array(np.arange(len(order), dtype=np.int64)), "id": pa.array(ids[order]), "count": pa.array(count[order])})
    spark.createDataFrame(ranks).coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(ids.max()) + 1 if len(ids) else 1, dtype=np.uint32)
    rank_of[ids[order]] = np.arange(len(order))
    shared = spark.sparkContext.broadcast(rank_of)

    # the ids as they are: coding them first would be done twice, since ranges are found by a look at all rows
    dealt = (tokens.filter("ids IS NOT NULL").select("doc_id", "key", "row", "ids")
             .repartitionByRange("doc_id", "key", "row").sortWithinPartitions("doc_id", "key", "row").select("doc_id", "ids"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, first = TaskContext.get().partitionId(), 0, 0
        held: list[pa.RecordBatch] = []
        total = 0

        def packed() -> pa.RecordBatch:
            doc_ids, ids = (pa.concat_arrays([rows.column(k) for rows in held]) for k in range(2))
            sizes = pc.binary_length(ids).to_numpy() // width
            control, data = encode(shared.value[np.frombuffer(b"".join(ids.to_pylist()), dtype=f"<u{width}")], sizes)
            bounds = pa.array([0, len(doc_ids)], pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([first], pa.int64()),
                 pa.ListArray.from_arrays(bounds, doc_ids), pa.ListArray.from_arrays(bounds, pa.array(sizes, pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                ["part", "block", "first", "doc_ids", "sizes", "control", "data"])

        for batch in batches:
            sizes = pc.binary_length(batch.column(1)).to_numpy() // width
            low = 0
            for high in range(1, batch.num_rows + 1):
                total += int(sizes[high - 1])
                if total >= BLOCK:
                    held.append(batch.slice(low, high - low))
                    yield packed()
                    held, low, block, first, total = [], high, block + 1, first + total, 0
            if low < batch.num_rows:
                held.append(batch.slice(low))
        if held:
            yield packed()

    kind = dict(tokens.dtypes)["doc_id"]
    (dealt.mapInArrow(pack, f"part int, block int, first long, doc_ids array<{kind}>, sizes array<long>, control binary, data binary")
     .write.option("compression", "zstd").parquet(f"{path}/blocks"))
    drop_stored(tokens)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it) and ids (little-endian unsigned 32-bit) of every document."""
    ranks = spark.read.parquet(f"{path}/ranks").toArrow()  # a row an id of the vocabulary at most
    id_of = np.zeros(max(1, ranks.num_rows), dtype="<u4")
    id_of[ranks["rank"].to_numpy()] = ranks["id"].to_numpy()
    shared = spark.sparkContext.broadcast(id_of)
    blocks = spark.read.parquet(f"{path}/blocks")
    ids_in = F.aggregate("sizes", F.lit(0).cast("long"), lambda total, size: total + size)
    # a row a part
    parts = blocks.groupBy("part").agg(F.sum(ids_in).alias("ids"))
    before = F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).cast("long").alias("before"))
    placed = blocks.join(parts, "part").select((F.col("before") + F.col("first")).alias("first"), "doc_ids", "sizes", "control", "data")

    def work(batch: pa.RecordBatch):
        for row in range(batch.num_rows):
            sizes = batch.column(2)[row].values.to_numpy()
            ids = shared.value[decode(batch.column(3)[row].as_buffer(), batch.column(4)[row].as_buffer(), sizes)]
            ends = np.cumsum(sizes)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1)[row].values, pa.array(batch.column(0)[row].as_py() + ends - sizes),
                 pa.array([ids[end - size:end].tobytes() for size, end in zip(sizes, ends)], pa.binary())], ["doc_id", "start", "ids"])

    kind = dict(blocks.dtypes)["doc_ids"].removeprefix("array<").removesuffix(">")
    return map_batches(placed, work, f"doc_id {kind}, start long, ids binary")


def op12_token_files(documents: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("word_bpe_49k.json")
    path = scratch_path(documents.sparkSession, "token_files")
    write_token_files(documents, path, tokenizer)
    return read_token_files(documents.sparkSession, path).select(
        "doc_id", "start", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
