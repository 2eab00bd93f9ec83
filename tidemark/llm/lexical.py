"""Ranked lexical search: the best documents of each query by the Best Position Algorithm over impact lists.

Terms are runs of letters A-Z, digits and characters beyond ASCII, A-Z lower-cased. With N documents that have a term, L
terms in all, n of a document, df documents with a term and tf occurrences in a document, a term weighs
w = floor(1000 ln((2 N + 2) / (2 df + 1))), its impact is w * ((10^9 tf) div (1000 tf + 8 m)) with
m = 10 + (90 n N) div L, and a document scores the sum of the impacts of the query's terms.

The first pass counts N, L and df of the queries' terms; the second searches. A task cuts its documents into blocks of
about ``POSTINGS`` (term, document) pairs and makes an impact list of each term, highest impact first, and for direct access
the terms of each document with their places in the lists. A query reads its lists in rounds, a number of entries of each
that doubles from round to round. Every document that comes up is scored at once by direct access to all lists, which marks
its place in each as seen. The best position of a list is the end of its run of seen places; no unseen document can have
more than the sum of the impacts just beyond the best positions. The search stops when that bound is below the k-th best
score, strictly, so that equal scores go to the smaller doc_id. The k best of a query are carried from block to block of a
task, so that later blocks stop earlier; each task returns k rows a query at most, and the k best of those are the result.

Queries are taken in blocks of ``QUERY_TERMS`` terms, so what is sent to the tasks has a fixed size; each block passes over
the documents of its own accord. Terms are compared by 64-bit hashes.

Cases: a null or empty text has no term and is not found; a query without terms has no rows. Rows that repeat a doc_id are
documents of their own; rows that repeat an item_id are queries of their own, each with its ranks, but equal rows are one
query. A null doc_id is smaller than all others. A term that every document holds weighs nothing, and a document that scores
0 is not found. Other columns are not read; tables may be empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.llm.words import ALNUM, each_piece

POSTINGS = 1 << 21
QUERY_TERMS = 1 << 18
FIRST_ROUND = 16
SHARE = 90  # of 100, how far the length of a document counts
DOCUMENTS, LENGTH = -1, -2


class Queries(NamedTuple):
    """A block of queries: the hashes of their terms in order, and the terms of query i at first[i]:first[i + 1]."""

    names: np.ndarray
    term: np.ndarray
    first: np.ndarray


class Weights(NamedTuple):
    """Weight of each term of a block of queries, number of documents and of all their terms."""

    term: np.ndarray
    documents: int
    length: int


class Postings(NamedTuple):
    """Terms of documents: ordered by document, then by term."""

    document: np.ndarray
    term: np.ndarray
    impact: np.ndarray


# ---- queries and counts ---------------------------------------------------------

def query_blocks(items: DataFrame) -> Iterator[tuple[list, Queries]]:
    """item_ids and terms of the queries, ``QUERY_TERMS`` terms at a time (a longer query alone)."""
    ids: list = []
    terms: list[np.ndarray] = []

    def block() -> tuple[list, Queries]:
        names, term = np.unique(np.concatenate(terms), return_inverse=True)
        return ids, Queries(names, term, np.concatenate(([0], np.cumsum([len(t) for t in terms]))))

    for row in items.select("item_id", "text").distinct().toLocalIterator():
        for _, _, words in each_piece(pa.array([row["text"]], pa.string()), ALNUM):
            own = np.unique(words.hash)
            if not len(own):
                continue
            if terms and sum(map(len, terms)) + len(own) > QUERY_TERMS:
                yield block()
                ids, terms = [], []
            ids.append(row["item_id"])
            terms.append(own)
    if terms:
        yield block()


def known_terms(texts: pa.Array, names: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each piece of the texts: its first text, the number of terms of each text, and the text (from the first), term
    and occurrences of every pair of a text and a term of ``names``, ordered by text and term."""
    for low, _, words in each_piece(texts, ALNUM):
        place = np.searchsorted(names, words.hash)
        held = np.flatnonzero(names[np.minimum(place, len(names) - 1)] == words.hash)
        pair, count = np.unique(words.text[held] * len(names) + place[held], return_counts=True)
        yield low, np.diff(words.first), pair // len(names), pair % len(names), count


def counted(documents: DataFrame, queries: Queries) -> Weights:
    """N, L and the weights of the queries' terms over all documents."""
    names = documents.sparkSession.sparkContext.broadcast(queries.names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(names.value), dtype=np.int64)
        texts = length = 0
        for batch in batches:
            for _, size, _, term, _ in known_terms(batch.column(0), names.value):
                texts += int(np.count_nonzero(size))
                length += int(size.sum())
                df += np.bincount(term, minlength=len(df))
        used = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(([DOCUMENTS, LENGTH], used))), pa.array(np.concatenate(([texts, length], df[used])))], ["term", "n"])

    rows = documents.select("text").mapInArrow(work, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    n = dict(zip(rows["term"].to_pylist(), rows["n"].to_pylist()))
    total = n.pop(DOCUMENTS, 0)
    length = n.pop(LENGTH, 0)
    df = np.zeros(len(queries.names), dtype=np.int64)
    df[np.fromiter(n.keys(), np.int64, len(n))] = np.fromiter(n.values(), np.int64, len(n))
    return Weights(np.floor(1000 * np.log((2 * total + 2) / (2 * df + 1))).astype(np.int64), total, length)


def impacts(weights: Weights, size: np.ndarray, term: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Impacts of terms that occur ``count`` times in documents of ``size`` terms."""
    m = 100 - SHARE + SHARE * size * weights.documents // weights.length
    return weights.term[term] * (1_000_000_000 * count // (1000 * count + 8 * m))


# ---- the search of a block --------------------------------------------------------

class Block:
    """Impact lists of a block of documents, whose numbers follow their doc_ids, and direct access to them."""

    def __init__(self, postings: Postings, documents: int, terms: int):
        used = postings.impact > 0
        self.document, self.term, self.impact = (part[used] for part in postings)
        order = np.lexsort((self.document, -self.impact, self.term))
        self.listed = self.document[order]
        self.height = self.impact[order]
        self.low = np.searchsorted(self.term[order], np.arange(terms + 1))
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.arange(len(order))
        self.first = np.searchsorted(self.document, np.arange(documents + 1))
        # the query that a place, a document or a term was last marked by
        self.seen = np.full(len(order), -1, dtype=np.int32)
        self.scored = np.full(documents, -1, dtype=np.int32)
        self.asked = np.full(terms, -1, dtype=np.int32)
        # sums of such impacts are exact as doubles
        self.small = not len(self.height) or int(self.height.max()) < 1 << 32

    def best(self, number: int, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best of query ``number`` that score ``floor`` or more, best first."""
        low, high = self.low[terms], self.low[terms + 1]
        low, high = low[high > low], high[high > low]
        self.asked[terms] = number
        position = low.copy()  # of the first unseen entry of each list
        depth, step = 0, FIRST_ROUND
        found, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        while len(low):
            entries = _ranges(np.minimum(low + depth, high), np.minimum(low + depth + step, high))
            fresh = np.unique(self.listed[entries])
            fresh = fresh[self.scored[fresh] != number]
            if len(fresh):
                self.scored[fresh] = number
                direct = _ranges(self.first[fresh], self.first[fresh + 1])
                direct = direct[self.asked[self.term[direct]] == number]
                self.seen[self.place[direct]] = number
                of = np.searchsorted(fresh, self.document[direct])
                score = self.sums(of, self.impact[direct], len(fresh))
                found, scores = np.concatenate((found, fresh)), np.concatenate((scores, score))
                best = np.lexsort((found, -scores))[:k]
                found, scores = found[best], scores[best]
            bound = 0
            for i in range(len(low)):
                unseen = np.flatnonzero(self.seen[position[i]:high[i]] != number)
                position[i] = position[i] + unseen[0] if len(unseen) else high[i]
                if len(unseen):
                    bound += int(self.height[position[i]])
            depth, step = depth + step, 2 * step
            if bound == 0 or bound < max(floor, int(scores[k - 1]) if len(scores) >= k else 0):
                break
        kept = scores >= max(floor, 1)
        return found[kept], scores[kept]

    def sums(self, of: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
        if self.small:
            return np.bincount(of, values, count).astype(np.int64)
        out = np.zeros(count, dtype=np.int64)
        np.add.at(out, of, values)
        return out


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """All numbers of low[i]:high[i], one range after the other."""
    count = high - low
    return np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())


class Best:
    """The k best of each query so far: (score, doc_id), best first."""

    def __init__(self, queries: Queries, k: int):
        self.queries, self.k = queries, k
        self.rows: list[list[tuple]] = [[] for _ in range(len(queries.first) - 1)]

    def search(self, ids: pa.Array, postings: Postings) -> None:
        """Takes a block of documents into account; ``ids`` are theirs."""
        # numbers that follow the doc_ids
        order = pc.sort_indices(ids, null_placement="at_start")
        number = np.empty(len(ids), dtype=np.int64)
        number[order.to_numpy()] = np.arange(len(ids))
        document = number[postings.document]
        again = np.lexsort((postings.term, document))
        block = Block(Postings(document[again], postings.term[again], postings.impact[again]), len(ids), len(self.queries.names))
        for i, had in enumerate(self.rows):
            terms = self.queries.term[self.queries.first[i]:self.queries.first[i + 1]]
            floor = had[-1][0] if len(had) == self.k else 0
            at, scores = block.best(i, terms, self.k, floor)
            if len(at):
                new = zip(scores.tolist(), ids.take(order.take(pa.array(at))).to_pylist())
                self.rows[i] = sorted(chain(had, new), key=lambda row: (-row[0], row[1] is not None, row[1]))[:self.k]


def search(documents: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id and score of the k best documents of each item (item_id, text)."""
    id_type = documents.schema["doc_id"].dataType
    item_type = items.schema["item_id"].dataType
    layout = T.StructType([T.StructField("item_id", item_type), T.StructField("rank", T.IntegerType()),
                           T.StructField("doc_id", id_type), T.StructField("score", T.LongType())])
    found = [_search_block(documents, item_ids, queries, k, item_type) for item_ids, queries in query_blocks(items)]
    if not found:
        return documents.sparkSession.createDataFrame([], layout)
    return reduce(DataFrame.unionAll, found)


def _search_block(documents: DataFrame, item_ids: list, queries: Queries, k: int, item_type: T.DataType) -> DataFrame:
    spark = documents.sparkSession
    weights = counted(documents, queries)
    sent = spark.sparkContext.broadcast((queries, weights))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = sent.value
        best = Best(queries, k)
        ids: list[pa.Array] = []
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        id_type, documents, pairs = None, 0, 0
        for batch in batches:
            id_type = batch.column(0).type
            for low, size, text, term, count in known_terms(batch.column(1), queries.names):
                ids.append(batch.column(0).slice(low, len(size)))
                held.append((text + documents, term, impacts(weights, size[text], term, count)))
                documents, pairs = documents + len(size), pairs + len(text)
                if pairs >= POSTINGS:
                    best.search(pa.concat_arrays(ids), Postings(*map(np.concatenate, zip(*held))))
                    ids, held, documents, pairs = [], [], 0, 0
        if held:
            best.search(pa.concat_arrays(ids), Postings(*map(np.concatenate, zip(*held))))
        rows = [(i, doc_id, score) for i, mine in enumerate(best.rows) for score, doc_id in mine]
        if rows:
            query, doc_ids, scores = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query, pa.int64()), pa.array(doc_ids, id_type), pa.array(scores, pa.int64())], ["query", "doc_id", "score"])

    kind = dict(documents.dtypes)["doc_id"]
    rows = documents.select("doc_id", "text").mapInArrow(work, f"query long, doc_id {kind}, score long")
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))))
    names = T.StructType([T.StructField("query", T.LongType()), T.StructField("item_id", item_type)])
    items = spark.createDataFrame(list(enumerate(item_ids)), names)
    return ranked.filter(F.col("rank") <= k).join(items, "query").select("item_id", "rank", "doc_id", "score")


def op11_lexical(documents: DataFrame, items: DataFrame) -> DataFrame:
    return search(documents, items, 10)
