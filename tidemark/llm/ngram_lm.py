"""Language-model scores by deleted interpolation.

Tokens are lower-cased words and one end token for each text; the first word's context is the end token. A token w after v
has probability l2 c(vw) / c(v) + l1 c(w) / N + l0 / (V + 1): the bigram, unigram and uniform estimates, mixed by weights
that depend on the bucket of c(v), the context's frequency (a bucket for each power of two, 0 on its own). The weights are
learned by expectation-maximisation on counts from which the token's own document is deleted, over all training texts.

Counts without sending tokens around: texts are read in chunks of ``CHUNK_ROWS`` rows. A chunk sends its distinct unigram
and bigram hashes with their training counts, sorted and packed in one array for each hash bucket; a bucket adds up its
hashes over all chunks and answers each chunk with what the others have counted, in the order it was asked. Scoring joins
the answers with the chunk's texts. All tokens of all training texts are counted; nothing is pruned. Hot words need no
care: a chunk asks for each hash once. The number of buckets follows the size of all texts, so a bucket stays small.

A chunk is a run of rows of one input split, so ``documents`` has to be a table read from files (projections and filters
are fine): all passes must see the same splits. The number of cores that splits are planned for is therefore fixed in the
session (``spark.sql.files.minPartitionNum``, if unset), so that lost executors do not change it, and every chunk compares
number and sum of its hashes with what it has asked, and fails where they differ.

EM needs only the ratios of the three estimates; they are counted in cells of a twentieth of a decade, at most a few
thousand for each bucket, and only these cells come to the driver.

Cases: a null or empty text is its end token. Rows are scored one by one, repeated rows alike (and counted each). A null
doc_id counts as the text ``null`` where rows are split. Without training texts the uniform estimate is left. Other
columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, stored
from tidemark.llm.words import SPACED, each_piece, mix

CHUNK_ROWS_LOG2 = 11
CHUNK_ROWS = 1 << CHUNK_ROWS_LOG2
BUCKET_BYTES = 8 << 20
BUCKETS = 40
CELLS = 20.0
ROUNDS = 60
END = np.uint64(0x2545F4914F6CDD1D)
LEAST = 1e-6


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, and the row of each."""
    found, rows = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high, words in each_piece(texts, SPACED):
        found.append(np.insert(words.hash, words.first[1:], END))
        rows.append(np.insert(words.text.astype(np.int64), words.first[1:], np.arange(high - low)) + low)
    return np.concatenate(found), np.concatenate(rows)


def bigrams(token: np.ndarray) -> np.ndarray:
    """Hashes of each token with the one before it; texts end with the end token, which starts the next."""
    before = np.concatenate((np.array([END], dtype=np.uint64), token[:-1]))[:len(token)]
    return mix(mix(before) + np.uint64(0x9E3779B97F4A7C15) * token)


def counted(key: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, their training counts, and each token's place among them."""
    distinct, place = np.unique(key, return_inverse=True)
    return distinct, np.bincount(place, train, len(distinct)).astype(np.int64), place


def _asked(chunk: int, texts: list[pa.Array], train: list[np.ndarray], bits: int) -> Iterator[pa.RecordBatch]:
    token, row = tokens(pa.concat_arrays(texts))
    used = np.concatenate(train)[row].astype(np.float64)
    out = []
    for kind, key in enumerate((token, bigrams(token))):
        distinct, count, _ = counted(key, used)
        bucket = (distinct >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(distinct), np.int64)
        head = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        for a, b in zip(head, [*head[1:], len(distinct)]):
            out.append((kind, int(bucket[a]), chunk, distinct[a:b].tobytes(), count[a:b].astype(np.uint32).tobytes()))
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["kind", "bucket", "chunk", "hashes", "counts"])


def asked(rows: DataFrame, bits: int) -> DataFrame:
    """The distinct hashes of each chunk, packed by bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, train = None, [], []
        for batch in batches:
            chunk = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(chunk[1:] != chunk[:-1]) + 1).tolist(), len(chunk)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if now is not None and chunk[a] != now:
                    yield from _asked(now, texts, train, bits)
                    texts, train = [], []
                now = int(chunk[a])
                texts.append(batch.column(1).slice(a, b - a))
                train.append(batch.column(2).slice(a, b - a).to_numpy(zero_copy_only=False))
        if now is not None:
            yield from _asked(now, texts, train, bits)

    return rows.select("chunk", "text", "train").mapInArrow(work, "kind int, bucket int, chunk long, hashes binary, counts binary")


def answered(questions: DataFrame) -> DataFrame:
    """For each question what other chunks have counted; types and tokens of a bucket stand in one of its rows."""

    def add_up(table: pa.Table) -> pa.Table:
        hashes = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
        counts = [np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]
        distinct, place = np.unique(np.concatenate(hashes), return_inverse=True)
        total = np.bincount(place, np.concatenate(counts), len(distinct)).astype(np.int64)
        more = np.split((total[place] - np.concatenate(counts)).astype(np.uint32), np.cumsum([len(h) for h in hashes])[:-1])
        first = np.arange(len(hashes)) == 0
        return pa.table({
            "chunk": table["chunk"], "kind": table["kind"], "bucket": table["bucket"],
            "check": pa.array([int(h.sum(dtype=np.uint64).view(np.int64)) for h in hashes], pa.int64()), "more": pa.array([m.tobytes() for m in more], pa.binary()),
            "types": pa.array(np.where(first, (total > 0).sum(), 0)), "tokens": pa.array(np.where(first, total.sum(), 0))})

    return questions.groupBy("kind", "bucket").applyInArrow(
        add_up, "chunk long, kind int, bucket int, check long, more binary, types long, tokens long")


class Counts:
    """The counts that the tokens of a chunk need."""

    def __init__(self, texts: pa.Array, train: np.ndarray, answers: pa.Table):
        self.token, self.row = tokens(texts)
        self.bigram = bigrams(self.token)
        used = train[self.row].astype(np.float64)
        kind, bucket = answers["kind"].to_numpy(), answers["bucket"].to_numpy()
        more, check = answers["more"].to_pylist(), answers["check"].to_numpy()
        totals = []
        for k, key in enumerate((self.token, self.bigram)):
            distinct, count, place = counted(key, used)
            order = [i for i in np.lexsort((bucket, kind)) if kind[i] == k]
            extra = np.concatenate([np.zeros(0, np.uint32), *(np.frombuffer(more[i], np.uint32) for i in order)])
            asked_sum = np.array([check[i] for i in order], dtype=np.int64).view(np.uint64).sum(dtype=np.uint64)
            if len(extra) != len(count) or asked_sum != distinct.sum(dtype=np.uint64):
                raise RuntimeError("documents were not read in the same chunks twice")
            totals.append((count + extra)[place])
        self.word, self.pair = totals
        # the context of a token is the token before it; before the first token of a text stands an end token
        ends = int(self.word[self.token == END][0]) if len(self.token) else 0
        self.context = np.concatenate((np.array([ends]), self.word[:-1]))[:len(self.word)]

    def less_own_document(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """word, pair, context and own tokens, each without the counts of the token's document."""
        salt = mix(self.row.astype(np.uint64) + np.uint64(1))
        own = []
        for key in (self.token, self.bigram):
            _, place, count = np.unique(key ^ salt, return_inverse=True, return_counts=True)
            own.append(count[place])
        head = np.concatenate(([True], self.row[1:] != self.row[:-1]))
        own_context = np.where(head, 1, np.concatenate(([1], own[0][:-1])))
        size = np.bincount(self.row)[self.row]
        return self.word - own[0], self.pair - own[1], self.context - own_context, size


def bucket_of(context: np.ndarray) -> np.ndarray:
    return np.where(context > 0, np.minimum(np.log2(np.maximum(context, 1)).astype(np.int64) + 1, BUCKETS - 1), 0)


def ratios(word, pair, context, total, types: int) -> tuple[np.ndarray, np.ndarray]:
    """Bigram and unigram estimates over the uniform one."""
    two = pair / np.maximum(context, 1) * (types + 1)
    one = word / np.maximum(total, 1) * (types + 1)
    return two, one


def _by_chunk(rows: DataFrame, answers: DataFrame, work, schema: str) -> DataFrame:
    return rows.groupBy("chunk").cogroup(answers.select("chunk", "kind", "bucket", "check", "more").groupBy("chunk")).applyInArrow(work, schema)


def weights_from(cells: list, buckets: int = BUCKETS) -> np.ndarray:
    """EM for the weights (bigram, unigram, uniform) of each bucket from counted cells of ratios."""
    weights = np.tile(np.array([0.4, 0.5, 0.1]), (buckets, 1))
    weights[0] = (0.0, 0.9, 0.1)
    grouped: dict[int, list] = {}
    for bucket, two, one, n in cells:
        grouped.setdefault(bucket, []).append((two, one, n))
    for bucket, rows in grouped.items():
        two, one, n = np.array(rows, dtype=float).T
        parts = np.stack((np.where(two > -999, 10.0 ** (two / CELLS), 0.0), np.where(one > -999, 10.0 ** (one / CELLS), 0.0), np.ones(len(n))), axis=1)
        if bucket == 0:
            parts[:, 0] = 0.0
        mixed = weights[bucket].copy()
        for _ in range(ROUNDS):
            share = parts * mixed
            share /= share.sum(axis=1, keepdims=True)
            mixed = np.maximum((share * n[:, None]).sum(axis=0) / n.sum(), LEAST)
            mixed[0] = 0.0 if bucket == 0 else mixed[0]
            mixed /= mixed.sum()
        weights[bucket] = mixed
    return weights


def learned(rows: DataFrame, answers: DataFrame, total: int, types: int) -> np.ndarray:
    """Weights by EM over all training texts."""
    if not total:
        return weights_from([]) * [0, 0, 1] + [0, 0, LEAST]

    def count(texts: pa.Table, replies: pa.Table) -> pa.Table:
        train = texts["train"].to_numpy()
        have = Counts(texts["text"].combine_chunks(), train, replies)
        word, pair, context, size = have.less_own_document()
        at = train[have.row]
        two, one = ratios(word, pair, context, total - size, types)
        with np.errstate(divide="ignore"):
            cell = [np.where(r > 0, np.round(np.log10(np.maximum(r, 1e-300)) * CELLS), -1000).astype(np.int64) for r in (two, one)]
        found, n = np.unique(np.stack((bucket_of(context), *cell))[:, at], axis=1, return_counts=True)
        return pa.table({"bucket": found[0], "two": found[1], "one": found[2], "n": n})

    cells = _by_chunk(rows, answers, count, "bucket long, two long, one long, n long")
    return weights_from(cells.groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).collect())


def lm_scores(documents: DataFrame, held_out: Column) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each document."""
    spark, setting = documents.sparkSession, "spark.sql.files.minPartitionNum"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, str(spark.sparkContext.defaultParallelism))
    rows = documents.select("doc_id", "text", held_out.alias("held_out"), (~held_out).alias("train"),
                            F.shiftright(F.monotonically_increasing_id(), CHUNK_ROWS_LOG2).alias("chunk"))
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(3, math.ceil(math.log2(max(size, 1) / BUCKET_BYTES))) if size > BUCKET_BYTES else 3
    answers = stored(answered(asked(rows, bits)), "lm_counts")
    known = answers.filter("kind = 0").agg(F.sum("types"), F.sum("tokens")).first()
    types, total = known[0] or 0, known[1] or 0
    weights = learned(rows, answers, total, types)

    def score(texts: pa.Table, replies: pa.Table) -> pa.Table:
        have = Counts(texts["text"].combine_chunks(), texts["train"].to_numpy(), replies)
        count = texts.num_rows
        two, one = ratios(have.word, have.pair, have.context, total, types)
        mixed = weights[bucket_of(have.context)]
        value = np.log10(mixed[:, 0] * two + mixed[:, 1] * one + mixed[:, 2]) - np.log10(types + 1)
        base = np.log10((have.word + 1) / (total + types + 1))
        return pa.table({
            "doc_id": texts["doc_id"], "held_out": texts["held_out"], "n_tokens": pa.array(np.bincount(have.row, minlength=count)),
            "n_known": pa.array(np.bincount(have.row, have.word > 0, count).astype(np.int64)),
            "train_tokens": pa.array(np.full(count, total)), "base_score": pa.array(np.bincount(have.row, base, count)),
            "score": pa.array(np.bincount(have.row, value, count))})

    return _by_chunk(rows, answers, score,
                     f"doc_id {dict(documents.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                     "base_score double, score double")


def op7_lm(documents: DataFrame) -> DataFrame:
    return lm_scores(documents, crc_mod(F.col("doc_id"), 7) == 2)
