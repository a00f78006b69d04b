"""Encoding: chunked equals whole, decoding gives the text back."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from boardloom.llm import corpus_tokens as ct

pytestmark = pytest.mark.skipif(not Path(ct.VOCABULARIES, "byte_bpe_50k.tiktoken").exists(), reason="no vocabulary")
KIND = "doc_id bigint, text string, ids string, id string, piece string"


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash", "clash", "clash") for i, t in enumerate(texts)], KIND)


def whole(text):
    return ct.encoder("byte_bpe_50k", ct.VOCABULARIES).encode_ordinary(text) if text else []


@pytest.mark.parametrize(("chunk", "overlap"), [(7, 5), (40, 12), (64, 64)])
def test_chunks_equal_whole(spark, chunk, overlap):
    rng = random.Random(chunk)
    parts = ["parola", " ", "  ", "\n\n", "l’istituto", "123456789", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "è😀", "...", "'s", "<|endoftext|>", "\t", " " * 50]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(120)] + ["", None, "x", "   "]
    got = {r.id: list(r.ids) for r in ct.encode(frame(spark, texts), "doc_id", F.col("text"), chunk=chunk, overlap=overlap).collect()}
    assert got == {i: whole(t) for i, t in enumerate(texts)}


def test_round_trip_and_counts(spark):
    texts = ["Perché «no» – 😀 Мост", "", None, "a" * 3000, "<|endoftext|>"]
    ids = ct.document_ids(frame(spark, texts))
    assert {r.doc_id: r.text for r in ct.decode(ids, "ids").collect()} == {i: t or "" for i, t in enumerate(texts)}
    counts = ct.token_counts(frame(spark, texts), ["doc_id"], F.col("text"))
    assert {r.doc_id: r.n_tokens for r in counts.collect()} == {i: len(whole(t)) for i, t in enumerate(texts)}
    assert ct.document_ids(frame(spark, [])).count() == 0


def test_documents_of_many_chunks(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["scuola", "n. 15/2026", "è", "avviso:", "\n\n", "«bando»", "12345"]) for _ in range(n)) for n in (10, 3_000, 9_000)] + ["x" * 10_000, " " * 5_000]
    assert max(map(len, texts)) > 10 * ct.CHUNK
    got = {r.doc_id: list(r.ids) for r in ct.document_ids(frame(spark, texts)).collect()}
    assert got == {i: whole(t) for i, t in enumerate(texts)}
