"""Quality classifier by co-training.

Two views of a document: its text content (frequencies of hashed words, word endings and byte pairs) and its page metadata
(language, source, length, lines, case, and the shares of kinds of bytes). Each view has a logistic classifier. In each of
``ROUNDS`` rounds both are trained on the labelled pool, then each names the unlabelled documents it is most confident of,
in both classes, as pseudo-labels for the other. At the end each view is calibrated by a logistic curve on labelled
documents kept out of its training, and the mean of the calibrated log odds scores every document.

Training is bounded by parameters: at most ``EACH`` labelled documents of a class and ``POOL`` unlabelled ones, drawn by a
hash of doc_id; their features come to the driver as ``TEXT_WIDTH`` + ``PAGE_WIDTH`` numbers each, which are held there once
and trained on in place. Scoring reads every whole text.

Cases: a null or empty text has zero content features and is scored by them like any other. Language and source are
hashed, null is a value of its own. Without labels of both classes every score is the share of good labels, 1 without
labels. Each row is scored alone, repeated rows alike. Columns other than doc_id, text, lang and source are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, map_batches
from tidemark.llm.linear import fit_logistic, labelled_ids, predict, sigmoid
from tidemark.llm.words import SPACED, Words, each_piece, hashes, text_buffers

TEXT_WIDTH, PAGE_WIDTH = 192, 32
EACH, POOL = (3000, 6000), 6000
ROUNDS, NAMED = 3, 400
RIDGE = 1.0
THRESHOLD = 0.5

_DIGIT, _UPPER_BYTE, _SIGN = (np.zeros(256, dtype=bool) for _ in range(3))
_DIGIT[48:58] = True
_UPPER_BYTE[65:91] = True
_SIGN[33:48] = _SIGN[58:65] = _SIGN[91:97] = _SIGN[123:127] = True


def _spread(slot: np.ndarray, text: np.ndarray, count: int, width: int) -> np.ndarray:
    """Counts of slots for each text."""
    return np.bincount(text * width + slot, minlength=count * width).reshape(count, width).astype(np.float64)


def text_view(words: Words) -> np.ndarray:
    """Content: shares of hashed words, word endings and inner byte pairs, and how much words repeat."""
    count, width = len(words.first) - 1, (TEXT_WIDTH - 2) // 2
    size = np.maximum(np.diff(words.first), 1)[:, None]
    word = (words.hash >> np.uint64(33)).astype(np.int64) % width
    ends = (hashes(words.data, np.maximum(words.start, words.end - 3), words.end) >> np.uint64(33)).astype(np.int64) % width
    text = words.text.astype(np.int64)
    pair = np.unique(np.stack((text.astype(np.uint64), words.hash)), axis=1) if len(text) else np.zeros((2, 0), np.uint64)
    distinct = np.bincount(pair[0].astype(np.int64), minlength=count)[:, None] / size
    runs = np.zeros(count)
    if len(text) > 1:
        same = (words.hash[1:] == words.hash[:-1]) & (text[1:] == text[:-1])
        runs = np.bincount(text[1:][same], minlength=count)
    return np.concatenate((np.sqrt(_spread(word, text, count, width) / size), np.sqrt(_spread(ends, text, count, width) / size),
                           distinct, runs[:, None] / size), axis=1)


def page_view(raw: np.ndarray, offset: np.ndarray, low: int, high: int, lang: list, source: list) -> np.ndarray:
    """Metadata: hashed language and source, length, lines, case and kinds of bytes."""
    body, bounds = raw[offset[low]:offset[high]], offset[low:high + 1] - offset[low]
    size = np.maximum(np.diff(bounds), 1)

    def share(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(flag)))
        return total[bounds[1:]] - total[bounds[:-1]]

    lines = share(body == 10) + 1
    spaces = share(body == 32) + lines
    kinds = [share(t[body]) for t in (_DIGIT, _UPPER_BYTE, _SIGN)] + [share(body >= 128), share(body == 124), share(body == 33)]
    plain = [np.log1p(np.diff(bounds)), np.log(lines), np.log(size / lines), size / spaces / 10, *(k / size * 5 for k in kinds),
             *(np.minimum(k / spaces, 3.0) for k in kinds[1:3])]
    out = np.zeros((high - low, PAGE_WIDTH))
    out[:, :len(plain)] = np.stack(plain, axis=1)
    free = PAGE_WIDTH - len(plain)
    for values in (lang, source):
        slot = [sum(ord(c) * 31 ** i for i, c in enumerate(str(v))) % free for v in values]
        out[np.arange(high - low), len(plain) + np.array(slot, dtype=int)] += 1
    return out


class Views(NamedTuple):
    """Per view: mean and spread of its features, coefficients and calibration."""

    text: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    page: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]

    def score(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        total = 0.0
        for x, (mean, spread, beta, curve) in ((text, self.text), (page, self.page)):
            total = total + predict(predict((x - mean) / spread, beta)[:, None], curve)
        return sigmoid(total / 2)


def constant(rate: float) -> Views:
    rate = min(max(rate, 1e-6), 1 - 1e-6)
    flat = [(np.zeros(w), np.ones(w), np.zeros(w + 1), np.array([0.0, np.log(rate / (1 - rate))])) for w in (TEXT_WIDTH, PAGE_WIDTH)]
    return Views(*flat)


def co_train(text: np.ndarray, page: np.ndarray, label: np.ndarray) -> Views:
    """``label``: 0, 1, or -1 for unlabelled rows. ``text`` and ``page`` are standardised in place."""
    views = []
    for x in (text, page):
        mean = x.mean(axis=0)
        x -= mean
        spread = np.sqrt(np.einsum("ij,ij->j", x, x) / len(x))
        spread = np.where(spread > 1e-9, spread, 1.0)
        x /= spread
        views.append((x, mean, spread))
    known = np.flatnonzero(label >= 0)
    kept_out = known[::4]
    own = [label.copy(), label.copy()]
    for y in own:
        y[kept_out] = -1
    free = np.flatnonzero(label < 0)
    betas = [None, None]
    for turn in range(ROUNDS + 1):
        for i, (x, _, _) in enumerate(views):
            rows = np.flatnonzero(own[i] >= 0)
            betas[i] = fit_logistic(x[rows], own[i][rows].astype(float), RIDGE)
        if turn < ROUNDS:
            for i, (x, _, _) in enumerate(views):
                open_ = free[own[1 - i][free] < 0]
                logit = predict(x[open_], betas[i])
                # as many of each class as the labels have, the surest first, and sure at all
                good = label[known].mean()
                for value, sign, share in ((1, -1, good), (0, 1, 1 - good)):
                    sure = open_[np.argsort(sign * logit, kind="stable")][:max(1, int(NAMED * share))]
                    sure = sure[-sign * predict(x[sure], betas[i]) > 2.0]
                    own[1 - i][sure] = value
    done = []
    for (x, mean, spread), beta in zip(views, betas):
        curve = fit_logistic(predict(x[kept_out], beta)[:, None], label[kept_out].astype(float), 0.01)
        done.append((mean, spread, beta, curve))
    return Views(*done)


def viewed(documents: DataFrame, carried: list[str]) -> DataFrame:
    """Both views of each document next to its ``carried`` columns."""
    def work(batch: pa.RecordBatch):
        offset, raw = text_buffers(batch.column("text"))
        for low, high, words in each_piece(batch.column("text"), SPACED):
            part = batch.slice(low, high - low)
            page = page_view(raw, offset, low, high, part.column("lang").to_pylist(), part.column("source").to_pylist())
            lists = [pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), v.shape[1]).cast(pa.list_(pa.float64()))
                     for v in (text_view(words), page)]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), *lists], [*carried, "text_x", "page_x"])

    kinds = dict(documents.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in carried) + ", text_x array<double>, page_x array<double>"
    return map_batches(documents.select(*dict.fromkeys([*carried, "text", "lang", "source"])), work, schema)


def matrix(column: pa.ChunkedArray, place: np.ndarray, width: int) -> np.ndarray:
    """The lists of ``column``, each in the row that ``place`` names."""
    out, low = np.empty((len(column), width)), 0
    for chunk in column.chunks:
        out[place[low:low + len(chunk)]] = chunk.flatten().to_numpy().reshape(-1, width)
        low += len(chunk)
    return out


def fitted(documents: DataFrame, labels: DataFrame, allowed: Column | None = None) -> Views:
    """The two classifiers, co-trained on bounded samples of labelled and unlabelled documents."""
    allowed = F.lit(True) if allowed is None else allowed
    chosen = labelled_ids(labels, "quality", allowed, EACH, 6)
    ids = documents.select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti").filter(F.col("doc_id").isNotNull())
    pool = ids.distinct().orderBy(F.xxhash64("doc_id", F.lit(6)), "doc_id").limit(POOL).select("doc_id", F.lit(-1).alias("label"))
    sample = documents.select("doc_id", "text", "lang", "source").join(F.broadcast(chosen.unionByName(pool)), "doc_id").dropDuplicates(["doc_id"])
    rows = viewed(sample, ["doc_id", "label"]).toArrow()
    order = pc.sort_indices(rows.select(["doc_id", "label"]), [("doc_id", "ascending"), ("label", "ascending")]).to_numpy()
    label = rows["label"].to_numpy()[order]
    known = label[label >= 0]
    if len(np.unique(known)) < 2 or min(np.bincount(known)) < 8:
        return constant(float(known.mean()) if len(known) else 1.0)
    draw = np.random.default_rng(6).permutation(len(label))
    place = np.empty(len(label), dtype=np.int64)
    place[order[draw]] = np.arange(len(label))
    text, page = matrix(rows["text_x"], place, TEXT_WIDTH), matrix(rows["page_x"], place, PAGE_WIDTH)
    del rows  # the driver holds the sample once
    return co_train(text, page, label[draw])


def scored(documents: DataFrame, views: Views, carried: list[str], name: str = "score") -> DataFrame:
    """``carried`` columns and, as ``name``, the score (probability of good quality) of each document."""
    shared = documents.sparkSession.sparkContext.broadcast(views)

    def work(batch: pa.RecordBatch):
        offset, raw = text_buffers(batch.column("text"))
        for low, high, words in each_piece(batch.column("text"), SPACED):
            part = batch.slice(low, high - low)
            page = page_view(raw, offset, low, high, part.column("lang").to_pylist(), part.column("source").to_pylist())
            score = shared.value.score(text_view(words), page)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in carried), pa.array(score)], [*carried, name])

    kinds = dict(documents.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in carried) + f", {name} double"
    return map_batches(documents.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*carried, "text", "lang", "source"])]), work, schema)


def good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns.

    Null and empty texts are scored by their metadata and the text view's value for no words; repeated rows score alike; columns may
    have any names.
    """
    score = free_name(documents, "_quality_score")
    rated = scored(documents, fitted(documents, labels), documents.columns, score)
    return rated.filter(F.col(score) >= THRESHOLD).drop(score)


def op6_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score and predicted (1: good) of every document."""
    views = fitted(documents, labels)
    return scored(documents, views, ["doc_id"]).select("doc_id", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
