"""Toxic spans and document scores by a linear-chain conditional random field.

Tokens are runs of letters and digits, lower-cased. A token's features are its word and its first four and five bytes,
hashed to ``FEATURES`` slots. The field has two states (clean, toxic), one weight per feature, and transition weights.

Labelled tokens: the labels mark documents, not tokens, so the tokens of labelled toxic documents are marked where a
feature is at least ``ODDS`` times as frequent in toxic documents as in clean ones, and too often for chance (a
log-likelihood ratio of ``SURE`` or more); tokens of clean documents are clean.
The field is trained on them by gradient steps on the conditional likelihood (forward-backward marginals against marks),
and its marginals decide afterwards. A logistic curve over the largest marginal, the expected number of toxic tokens and
the length turns marginals into a document score.

Copies and near copies would pass for evidence, so of sampled documents that share one of ``SIGNS`` min-hashes of their
four-word runs only the first is used.

Training takes at most ``EACH`` labelled documents (clean, toxic) of ``SAMPLE_CHARS`` characters in all, the longest going first where
there are more; every document is
scored whole. The state recursions run over all tokens of a piece at once: every token is computed from its neighbour,
and tokens whose neighbour changed again, until none changes by 1e-9 (they contract, so this is the exact result).

Cases: a null or empty text has no tokens and gets the score of one without toxic tokens. Without labels of both classes
the score is the share of toxic labels, 0.5 if there are none. Each row is scored by its text alone, repeated rows alike;
labels, language, source and id are no inputs. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import crc_mod, map_batches
from tidemark.llm.linear import fit_logistic, labelled_ids, predict, sigmoid
from tidemark.llm.words import ALNUM, Words, each_piece, grams, hashes, mix, signed

FEATURES = 1 << 18
PREFIXES = (4, 5)
EACH, SAMPLE_CHARS = (2000, 1000), 16_000_000
ODDS, SURE = 20.0, 25.0
SIGNS, RUN = 8, 4
STEPS, RATE, SHRINK = 25, 0.5, 1e-3
THRESHOLD, SPAN_FROM = 0.3, 0.5


def features(words: Words) -> np.ndarray:
    """Feature slots of each token, one column for each kind."""
    ends = [words.end, *(np.minimum(words.end, words.start + n) for n in PREFIXES)]
    salts = np.arange(1, len(ends) + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    found = [hashes(words.data, words.start, end) ^ salt for end, salt in zip(ends, salts)]
    return np.stack([(f >> np.uint64(20)) & np.uint64(FEATURES - 1) for f in found], axis=1).astype(np.int32)


class Field(NamedTuple):
    """Weights: feature and bias are for the toxic state; trans[i, j] from state i to j; curve turns marginals to scores."""

    feature: np.ndarray
    bias: float
    trans: np.ndarray
    curve: np.ndarray


def _settle(size: int, start: np.ndarray, step) -> np.ndarray:
    """value[t] = step(t, value[t - 1]) for all t but those in ``start``, where it is step(t, None)."""
    head = np.zeros(size, dtype=bool)
    head[start] = True
    value = np.zeros(size)
    value[start] = step(start, None)
    todo = np.flatnonzero(~head)
    while len(todo):
        new = step(todo, value[todo - 1])
        moved = todo[np.abs(new - value[todo]) > 1e-9]
        value[todo] = new
        todo = moved + 1
        todo = todo[todo < size]
        todo = todo[~head[todo]]
    return value


def marginals(score: np.ndarray, first: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(toxic) of each token, and the log odds of the forward and the backward pass.

    ``score``: log odds of each token alone; ``first``: bounds of the sequences.
    """
    heads = first[:-1][np.diff(first) > 0]
    tails = first[1:][np.diff(first) > 0] - 1
    t = trans

    def forward(at, before):
        if before is None:
            return score[at]
        return score[at] + np.logaddexp(t[0, 1], t[1, 1] + before) - np.logaddexp(t[0, 0], t[1, 0] + before)

    ahead = _settle(len(score), heads, forward)
    back_score = score[::-1]

    def backward(at, before):
        if before is None:
            return np.zeros(len(at))
        next_ = back_score[at - 1] + before
        return np.logaddexp(t[1, 0], t[1, 1] + next_) - np.logaddexp(t[0, 0], t[0, 1] + next_)

    behind = _settle(len(score), len(score) - 1 - tails[::-1], backward)[::-1]
    return sigmoid(ahead + behind), ahead, behind


def document_features(p: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Largest marginal (as log odds), expected toxic tokens and length, both as logarithms."""
    count = np.diff(first)
    top, total = np.zeros(len(count)), np.zeros(len(count))
    held = np.flatnonzero(count)
    if len(held):
        top[held] = np.maximum.reduceat(p, first[:-1][held])
        total[held] = np.add.reduceat(p, first[:-1][held])
    top = np.clip(top, 1e-5, 1 - 1e-5)
    return np.column_stack((np.log(top / (1 - top)), np.log1p(total), np.log1p(count)))


def signs(words: Words) -> np.ndarray:
    """Min-hashes of each text; a text shorter than a run has one of all its words."""
    count = len(words.first) - 1
    value, at = grams(words, RUN)
    text = words.text[at]
    out = np.zeros((count, SIGNS), dtype=np.uint64)
    held = np.unique(text)
    bounds = np.searchsorted(text, held)
    for k in range(SIGNS):
        if len(held):
            out[held, k] = np.minimum.reduceat(mix(value + np.uint64(k + 1)), bounds)
    for i in np.setdiff1d(np.arange(count), held):
        own = words.hash[words.first[i]:words.first[i + 1]]
        out[i] = mix(np.cumsum(np.append(own, np.uint64(len(own))))[-1:] + np.arange(SIGNS, dtype=np.uint64))
    return signed(out)


def first_of_copies(found: np.ndarray) -> np.ndarray:
    """Which texts share no sign with an earlier one."""
    fresh = np.ones(len(found), dtype=bool)
    for k in range(found.shape[1]):
        _, where = np.unique(found[:, k], return_index=True)
        once = np.zeros(len(found), dtype=bool)
        once[where] = True
        fresh &= once
    return fresh


def marked(slots: np.ndarray, first: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Marks of tokens from labels of documents."""
    document = np.repeat(np.arange(len(label)), np.diff(first))
    counts = []
    for value in (1, 0):
        rows = label[document] == value
        pairs = np.unique(document[rows].astype(np.int64)[:, None] * FEATURES + slots[rows])
        counts.append(np.bincount(pairs % FEATURES, minlength=FEATURES))
    toxic, clean = counts
    share = label.mean()
    odds = (toxic + 0.5) / (label.sum() + 1) / ((clean + 0.5) / ((1 - label).sum() + 1))
    expected = np.maximum((toxic + clean) * share, 1e-9), np.maximum((toxic + clean) * (1 - share), 1e-9)
    ratio = 2 * (toxic * np.log(np.maximum(toxic, 1e-9) / expected[0]) + clean * np.log(np.maximum(clean, 1e-9) / expected[1]))
    telling = (odds >= ODDS) & (ratio >= SURE)
    return (telling[slots].any(axis=1) & (label[document] == 1)).astype(float)


def train(slots: np.ndarray, first: np.ndarray, label: np.ndarray) -> Field:
    """Gradient steps on the conditional likelihood of the marks, scaled by running squares, then the curve."""
    y = marked(slots, first, label)
    weight, bias, trans = np.zeros(FEATURES), -2.0, np.zeros((2, 2))
    used, where = np.unique(slots, return_inverse=True)
    where = where.reshape(slots.shape)
    w = weight[used]
    inner = np.ones(len(y), dtype=bool)
    inner[first[1:][np.diff(first) > 0] - 1] = False
    now = np.flatnonzero(inner)
    yi = y[now].astype(int) * 2 + y[now + 1].astype(int)
    seen = np.bincount(yi, minlength=4).reshape(2, 2)
    sums = [np.zeros(len(w)), 0.0, np.zeros((2, 2))]
    for _ in range(STEPS):
        score = w[where].sum(axis=1) + bias
        p, ahead, behind = marginals(score, first, trans)
        gap = y - p
        grad_w = np.bincount(where.ravel(), np.repeat(gap, slots.shape[1]), len(w)) - SHRINK * w * len(y) / len(w)
        joint = np.zeros((len(now), 4))
        for i in (0, 1):
            for j in (0, 1):
                joint[:, 2 * i + j] = ahead[now] * i + trans[i, j] + (score[now + 1] + behind[now + 1]) * j
        joint = np.exp(joint - joint.max(axis=1, keepdims=True))
        joint /= joint.sum(axis=1, keepdims=True)
        grads = [grad_w, gap.sum(), seen - joint.sum(axis=0).reshape(2, 2)]
        sums = [s + g * g for s, g in zip(sums, grads)]
        steps = [RATE * g / (np.sqrt(s) + 1e-8) for g, s in zip(grads, sums)]
        w, bias, trans = w + steps[0], bias + steps[1], trans + steps[2]
    weight[used] = w
    p, _, _ = marginals(w[where].sum(axis=1) + bias, first, trans)
    return Field(weight.astype(np.float32), float(bias), trans, fit_logistic(document_features(p, first), label))


def fitted(documents: DataFrame, labels: DataFrame, allowed: Column, each: tuple[int, int] = EACH) -> Field:
    """The field, trained on a bounded sample of labelled documents."""
    chosen = labelled_ids(labels.select("doc_id", F.col("toxic")), "toxic", allowed, each, 10)
    sample = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])
    # whole texts of any length as far as the sum allows; no more rows than were chosen are put in order
    size = F.coalesce(F.length("text"), F.lit(0))
    sample = (sample.withColumn("_chars", F.sum(size).over(Window.orderBy(size, "doc_id").rowsBetween(Window.unboundedPreceding, 0)))
              .filter(F.col("_chars") <= SAMPLE_CHARS).drop("_chars"))

    def work(batch: pa.RecordBatch):
        for low, high, words in each_piece(batch.column(1), ALNUM):
            slots = features(words)
            lists = pa.ListArray.from_arrays(pa.array(words.first * slots.shape[1], pa.int32()), pa.array(slots.ravel()))
            found = signs(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column(2).slice(low, high - low).cast(pa.int32()), lists,
                 *(pa.array(found[:, k]) for k in range(SIGNS))], ["label", "slots", *sign_names])

    sign_names = [f"sign{k}" for k in range(SIGNS)]
    rows = map_batches(sample, work, "label int, slots array<int>, " + ", ".join(f"{n} long" for n in sign_names)).toArrow()
    found = np.stack([rows[n].to_numpy() for n in sign_names], axis=1)
    order = np.lexsort(found.T)  # partitions come in any order; training must not depend on it
    rows = rows.take(order[first_of_copies(found[order])])
    label = rows["label"].to_numpy().astype(float)
    if len(np.unique(label)) < 2:
        rate = float(label.mean()) if len(label) else 0.5
        rate = min(max(rate, 1e-3), 1 - 1e-3)
        return Field(np.zeros(FEATURES, np.float32), -20.0, np.zeros((2, 2)), np.array([0, 0, 0, np.log(rate / (1 - rate))]))
    lists = rows["slots"].combine_chunks()
    wide = 1 + len(PREFIXES)
    sizes = np.diff(lists.offsets.to_numpy()) // wide
    slots = lists.flatten().to_numpy().reshape(-1, wide)
    return train(slots, np.concatenate(([0], np.cumsum(sizes))), label)


def spans_of(words: Words, text: int, toxic: np.ndarray) -> str:
    """Code point offsets of runs of toxic tokens, as ``start:end``, comma-joined."""
    base = words.start[words.first[text]]
    # the zero byte before a text ends the one before it
    while base and words.data[base - 1]:
        base -= 1
    lead = (words.data[base:words.end[toxic[-1]]] & 0xC0) != 0x80
    at = np.concatenate(([0], np.cumsum(lead)))
    cuts = np.flatnonzero(np.diff(toxic) > 1)
    heads, tails = np.concatenate((toxic[:1], toxic[cuts + 1])), np.concatenate((toxic[cuts], toxic[-1:]))
    return ",".join(f"{at[words.start[a] - base]}:{at[words.end[b] - base]}" for a, b in zip(heads, tails))


def scored(documents: DataFrame, field: Field) -> DataFrame:
    """doc_id, score, n_toxic (tokens) and spans of each document."""
    shared = documents.sparkSession.sparkContext.broadcast(field)

    def work(batch: pa.RecordBatch):
        model = shared.value
        for low, high, words in each_piece(batch.column(1), ALNUM):
            score = model.feature[features(words)].sum(axis=1, dtype=np.float64) + model.bias
            p, _, _ = marginals(score, words.first, model.trans)
            result = sigmoid(predict(document_features(p, words.first), model.curve))
            toxic = np.flatnonzero(p >= SPAN_FROM)
            count = np.bincount(words.text[toxic], minlength=high - low)
            spans = [""] * (high - low)
            for text in np.flatnonzero(count):
                spans[text] = spans_of(words, text, toxic[words.text[toxic] == text])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.array(result), pa.array(count.astype(np.int64)), pa.array(spans)],
                ["doc_id", "score", "n_toxic", "spans"])

    source = documents.select("doc_id", "text")
    return map_batches(source, work, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, score double, n_toxic long, spans string")


def op10_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    field = fitted(documents, labels, ~held_out)
    return scored(documents, field).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_toxic", "spans")
