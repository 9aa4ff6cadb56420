"""Token counts by chunks against the library on whole texts."""

import random

import public_tokenizers
import pytest
from conftest import TABLES

from tidyloom.llm import queries, token_counts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def texts(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()]


@pytest.fixture(scope="module")
def odd():
    rng = random.Random(1)
    mixed = "".join(rng.choice("ab \n▁é日\U0001f600\t0") for _ in range(4000))
    return ["", " ", "a" * 5000, " " * 3000, "\n" * 700, "ab" * 2000, "▁" * 300 + "x", "日本語" * 300, "\U0001f600" * 200, "<s></s><unk>" * 100, "é" * 400, "\x00a" * 100, mixed]


@pytest.mark.parametrize("chunk, overlap", [(7, 2), (50, 3), (1000, 16)])
def test_chunks_equal_whole(texts, odd, chunk, overlap):
    counter = token_counts.Counter(MODEL, chunk, overlap)
    for text in odd + [(t or "")[:6000] for _, t in texts[:80]]:
        assert counter.count(text) == len(counter.model.encode(text)), text[:80]
    assert counter.widened or chunk > 7  # short overlaps had to grow


def test_no_common_token_goes_back_to_the_start(monkeypatch):
    counter = token_counts.Counter(MODEL, 20, 4)
    monkeypatch.setattr(counter, "_common", lambda left, right: None)
    text = "some words that are never joined " * 5
    assert counter.count(text) == len(counter.model.encode(text)) and counter.widened


def test_query(spark, texts):
    found = {r["doc_id"]: tuple(r) for r in queries.op13_tokens(spark, TABLES).collect()}
    model = token_counts.Counter(MODEL).model
    assert len(found) == len(texts)
    for doc, text in texts:
        tokens = len(model.encode(text or ""))
        assert found[doc][:4] == (doc, len((text or "").encode()), tokens, tokens > 4096)


def test_odd_rows(spark, odd):
    rows = [(None, "no id", "x", 1), (1, None, "x", 1), (2, "twice", "x", 1), (2, "twice", "x", 1), (3, "word " * 60_000, "x", 1), *((10 + i, t, "x", 1) for i, t in enumerate(odd))]
    frame = spark.createDataFrame(rows, "doc_id long, text string, id string, n_tokens long")
    model = token_counts.Counter(MODEL).model
    expected = sorted(((d, len((t or "").encode()), len(model.encode(t or ""))) for d, t, *_ in rows), key=str)
    for chunk in (100, 1 << 16):
        found = token_counts.token_counts(frame, MODEL, chunk_chars=chunk)
        assert sorted((tuple(r)[:3] for r in found.collect()), key=str) == expected
    assert token_counts.token_counts(frame.limit(0), MODEL).collect() == []
