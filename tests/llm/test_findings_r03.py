"""What the third review found in the text operators at size: the driver's memory and CPU time."""

from __future__ import annotations

import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa

from tidemark.llm import quality, token_files


def test_training_of_the_quality_classifier_holds_its_sample_once():
    """pipeline, driver's memory: peak of all that is allocated next to the sample itself."""
    rng = np.random.default_rng(1)
    label = np.where(np.arange(8000) % 2 == 0, -1, rng.integers(0, 2, 8000))
    text = rng.normal(size=(8000, quality.TEXT_WIDTH)) + 0.1 * np.maximum(label, 0)[:, None]
    page = rng.normal(size=(8000, quality.PAGE_WIDTH)) + 0.1 * np.maximum(label, 0)[:, None]
    raw = text.copy(), page.copy()
    tracemalloc.start()
    views = quality.co_train(text, page, label)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * text.nbytes
    assert np.mean((views.score(*raw) >= 0.5)[label >= 0] == label[label >= 0]) > 0.7


def test_rows_of_the_sample_are_placed_whatever_their_chunks():
    rows = [[float(10 * i + j) for j in range(3)] for i in range(5)]
    column = pa.chunked_array([pa.array(rows[:2]), pa.array(rows[:0], pa.list_(pa.float64())), pa.array(rows)[2:]])
    place = np.array([3, 0, 4, 1, 2])
    assert quality.matrix(column, place, 3)[place].tolist() == rows


def test_runs_met_lately_are_not_tokenised_again(monkeypatch):
    """op12_token_files, CPU seconds: a full cache was emptied, and every frequent word went through the merges anew."""
    monkeypatch.setattr(token_files, "KNOWN", 40)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read(), True, 2)
    learnt = []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda runs: learnt.extend(runs) or learn(runs))
    usual = "The café's 12 words, don't; ÀÉÎ Straße tail... \u4e2d\u6587 \u0130x <|endoftext|> x\u00a0y \x00 ' it's"
    texts = [f"{usual}\tw{i} v{i}x,\nend" for i in range(120)]
    found = [ids for low in range(0, len(texts), 3) for ids in encoder.ids(texts[low:low + 3])]
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(learnt) == len(set(learnt)) and len(encoder.runs.fresh) + len(encoder.runs.old) < 120


def test_distinct_runs_of_a_chunk_are_looked_up_once(monkeypatch):
    """op12_token_files, CPU seconds: every word of a text was looked up, however often it came."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read(), True, 2)
    asked = []
    known = encoder.runs.known
    monkeypatch.setattr(encoder.runs, "known", lambda keys: asked.extend(keys) or known(keys))
    texts = [" the cat, the dog and the 3 cats\n" * 40, "", " \t", "a </w> b</w>, </w>the", "the cat,", "x\x1cy the\x0b\x0cdog"]
    array = pa.array(["not read", *texts], pa.string()).slice(1)
    for text, ids in zip(texts, encoder.coded(array).to_pylist(), strict=True):
        assert np.frombuffer(ids, "<u2").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(asked) == len(set(asked)) == len({run for text in texts for run in text.encode().split()} | {b""})


def test_pieces_have_the_ids_of_their_own_merges():
    """op12_token_files: new pieces are merged at once and cut at the ends of words, also where a text spells such an end."""
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        encoder = token_files.Encoder(file.read(), True, 2)
    plain = ["the", "oiseau", "école", "...", "7", "zzxqj", "'s"]
    for pieces in (plain, [*plain, "</w>", "x</w>y"], ["a"]):
        assert encoder.merged(pieces) == [encoder.packed([[t.id for t in encoder.merges(encoder.spelled(p)[0][0])]])[0] for p in pieces]
