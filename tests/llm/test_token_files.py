"""Token files: exact round trips and the documents' own ids."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import token_files
from tidemark.llm.token_files import Encoder, decode, encode, op12_token_files, read_token_files, write_token_files

from .cases import document_rows, documents

public = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path("word_bpe_49k.json"))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.integers(0, 300), st.integers(0, (1 << 32) - 1)), max_size=40), max_size=8))
def test_streams_decode_to_what_was_encoded(texts):
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    flat = [rank for t in texts for rank in t]
    control, data = encode(np.array(flat, dtype=np.uint32), sizes)
    assert decode(control, data, sizes).tolist() == flat
    assert len(control) == sum(-(-n // 4) for n in sizes.tolist())


def test_lengths_of_the_code():
    control, data = encode(np.array([0, 255, 256, 65535, 65536, (1 << 24) - 1, 1 << 24], dtype=np.uint32), np.array([7]))
    assert len(control) == 2 and len(data) == 1 + 1 + 2 + 2 + 3 + 3 + 4


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=30), st.text("abSTdlvremé'’ßÄ.,5 <|", max_size=30)), max_size=5))
def test_runs_between_white_space_have_the_ids_of_the_whole_text(texts):
    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = file.read()
    own = _OWN.get("own") or _OWN.setdefault("own", Encoder(model, True, 4))
    assert own.ids(texts) == own.encoded(texts)


_OWN: dict[str, Encoder] = {}


def test_odd_texts_by_runs(tokenizer):
    with open(public.path("word_bpe_49k.json"), encoding="utf-8") as file:
        own = Encoder(file.read(), True, 4)
    texts = ["Don't I'LL they'd 'sis x''s ÀÉö×÷ß ªº µm 12,5% a-b_c", "<|endoftext|> <|EndOfText|>x", "á ́b", "\x1c x\xa0\x1fy\x85z　", "ΑΣ ΑΣ.Σ", "don't  DON'T\t'S", "", " \n", "é" * 50]
    assert own.ids(texts) == [np.array(ids_of(tokenizer, t)[:-1], "<u4").tobytes() for t in texts]


def test_files_hold_every_document(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK", 100)
    rows = documents(spark).withColumnsRenamed({"size": "key", "u": "row"})
    got = op12_token_files(rows.repartition(4)).orderBy("start").collect()
    order = sorted(document_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for r, row in zip(got, order, strict=True):
        ids = np.array(ids_of(tokenizer, row[1]), "<u4")
        assert tuple(r) == (row[0], start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert op12_token_files(rows.limit(0)).collect() == []
    as_text = op12_token_files(rows.withColumn("doc_id", F.col("doc_id").cast("string"))).orderBy("start").collect()
    assert [r["doc_id"] for r in as_text] == sorted((None if r[0] is None else str(r[0]) for r in order), key=lambda x: (x is not None, x or ""))


def test_frequent_ids_take_one_byte(spark, sf_dir, tmp_path, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    write_token_files(docs, str(tmp_path / "files"), public.path("word_bpe_49k.json"))
    ranks = spark.read.parquet(str(tmp_path / "files/ranks")).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == list(range(len(ranks)))
    assert [(-r["count"], r["id"]) for r in ranks] == sorted((-r["count"], r["id"]) for r in ranks)
    blocks = spark.read.parquet(str(tmp_path / "files/blocks"))
    size, data = blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)), F.sum(F.octet_length("data"))).first()
    assert size == sum(r["count"] for r in ranks)
    assert data == sum(r["count"] * (1 if r["rank"] < 256 else 2) for r in ranks)
    whole = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in read_token_files(spark, str(tmp_path / "files")).collect():
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids_of(tokenizer, whole[row["doc_id"]])
