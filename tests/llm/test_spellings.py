"""Spelling variants against plain sets of one-letter edits, in one block and in many."""

import collections
import random
import re
import zlib

import numpy as np
import pytest
from conftest import TABLES

from tidyloom.llm import queries, spellings


def plain(rows):
    counts = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near, replaced = collections.defaultdict(set), collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            replaced[w[:i], w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in replaced.values():
        for w in group:
            near[w] |= group - {w}
    best = {w: min(near[w], key=lambda x: (-words[x], x)) for w in words if near[w]}
    form = {w: b for w, b in best.items() if words[b] >= 2 * words[w]}
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return sorted(out)


@pytest.fixture(scope="module")
def made(spark):
    rng = random.Random(2)
    words = ["".join(rng.choice("abé") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    rows = [(rng.choice([None, *range(40)]), " ".join(rng.choices(words, k=60)), "x", "y", 1) for _ in range(60)]
    rows += [(1, None, "", "", 1), (2, "", "", "", 1), (3, "×÷À Ābcdefg İstanbul " * 3, "", "", 1), (4, "q" * 100_000 + " " + "q" * 99_999, "", "", 2)]
    rows += rows[-1:] * 3
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n string, length int")


@pytest.mark.parametrize("block_words", [1024, 7, 1])
def test_made_rows(made, block_words):
    found = spellings.spelling_variants(made, damage_every=97, block_words=block_words)
    assert sorted(map(tuple, found.collect())) == plain([tuple(r)[:2] for r in made.collect()])


def test_query(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    assert sorted(map(tuple, queries.op12_spellings(spark, TABLES).collect())) == plain([tuple(r) for r in docs.collect()])


def test_undamaged_and_empty(spark, made):
    assert spellings.spelling_variants(made.limit(0)).collect() == []
    frame = spark.createDataFrame([(1, "Colour colour COLOUR colours color color color color color color coloré coloré coloré")], "doc_id long, text string")
    found = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in spellings.spelling_variants(frame).collect()}
    assert found == {"colour": ("color", "color", 3, 1, 6), "color": (None, "color", 6, 2, None), "coloré": ("color", "color", 3, 1, 6)}


def test_long_chains(spark):
    # Each word is one letter away from a word twice as frequent: roots are reached by doubling steps.
    words = ["".join("b" if i < k else "a" for i in range(9)) for k in range(9)]
    frame = spark.createDataFrame([(k, f"{w} " * (3 << k)) for k, w in enumerate(words)], "doc_id long, text string")
    assert {r["root"] for r in spellings.spelling_variants(frame).collect()} == {words[-1]}


def test_counts_are_sent_in_parts(made):
    whole, parts = (sorted(map(tuple, spellings.word_counts(made, damage_every=97, held_words=n).collect())) for n in (10**6, 20))
    assert whole == parts


def test_tile_is_exact():
    words = ["".join(np.random.default_rng(i).choice(list("ab"), 6)) for i in range(60)] + ["Š" * 6]
    longer = [w[:i] + "c" + w[i:] for i, w in enumerate(words[:6])]
    i, j = spellings.tile(spellings.matrix(words, 6), spellings.matrix(longer, 7))
    expected = {(a, b) for a, w in enumerate(words) for b, v in enumerate(longer) if any(v[:k] + v[k + 1 :] == w for k in range(7))}
    assert set(zip(i.tolist(), j.tolist())) == expected
