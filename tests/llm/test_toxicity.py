"""The scale of op7_toxicity's scores."""

import collections
import math
import random
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import pytest
from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import functions as F

from tidyloom.llm import decontaminate, minhash, packing, personal, toxicity
from tidyloom.llm import words as words_of_texts
from tidyloom.llm.queries import tokenizer


def test_scores_keep_their_scale_when_the_larger_class_is_cut(spark):
    # One row in ten is toxic; the word that tells is in 60 % of the toxic rows and in 20 % of the others.
    draw = random.Random(5)
    rows = []
    for i in range(3000):
        toxic = int(i % 10 == 0)
        words = [draw.choice("stone river cloud table green seven paper north".split()) for _ in range(8)]
        rows.append((i, " ".join([*words, "wretch"] if draw.random() < (0.6 if toxic else 0.2) else words), toxic))
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int").coalesce(2)
    for most in (12_000, 600):
        scored = toxicity.toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True), max_labelled=most)
        assert abs(scored.agg(F.avg("score")).first()[0] - 0.1) < 0.05


def plain_ratio(word, counts, order=toxicity.ORDER, discount=toxicity.DISCOUNT):
    """The log-ratio of a word by dictionaries: interpolated Kneser-Ney in each class, shared lower orders."""
    padded = lambda w: bytes([1] * (order - 1)) + w + b"\x02"
    grams = [collections.Counter(), collections.Counter()]
    for w, per_class in counts.items():
        for c in (0, 1):
            for i in range(order - 1, len(padded(w))):
                if per_class[c]:
                    grams[c][padded(w)[i - order + 1 : i + 1]] += per_class[c]
    seen = {g for c in (0, 1) for g in grams[c]}

    def shared(gram):
        if not gram:
            return 1 / 256
        longer = {g[-len(gram) - 1 :] for g in seen}
        here = [g for g in longer if g[1:-1] == gram[:-1]]
        if not here:
            return shared(gram[1:])
        kinds = len({g[1:] for g in here})
        return max(sum(g[1:] == gram for g in here) - discount, 0) / len(here) + discount * kinds / len(here) * shared(gram[1:])

    total = 0.0
    for i in range(order - 1, len(padded(word))):
        gram, logs = padded(word)[i - order + 1 : i + 1], []
        for c in (0, 1):
            here = {g: n for g, n in grams[c].items() if g[:-1] == gram[:-1]}
            n = sum(here.values())
            fall = discount * len(here) / n if n else 1.0
            logs.append(math.log(max(here.get(gram, 0) - discount, 0) / max(n, 1) + fall * shared(gram[1:])))
        total += logs[0] - logs[1]
    return total


def test_evidence_equals_a_plain_model():
    draw = random.Random(8)
    counts = {"".join(draw.choice("abé") for _ in range(draw.randrange(1, 8))).encode(): (draw.randrange(4), draw.randrange(1, 4)) for _ in range(40)}
    words = list(counts)
    evidence = toxicity.Evidence(words, *(np.array([counts[w][c] for w in words], dtype=float) for c in (0, 1)))
    for word, found in zip(words, evidence.of(words)):
        # A gram that neither class has seen falls back to one shared value, which the ratio does not need.
        assert math.isclose(found, plain_ratio(word, counts), abs_tol=1e-9)
    new = [b"abab", b"bbbbbbbb", b"\xc3\xa9\xc3\xa9a"]
    assert all(math.isclose(a, plain_ratio(w, counts), abs_tol=1e-9) for w, a in zip(new, evidence.of(new)))


def test_long_labelled_texts_are_learned_from(spark):
    draw = random.Random(6)
    common = ["".join(draw.choice("aeiorstn") for _ in range(6)) for _ in range(300)]
    rows = [(i, " ".join([*draw.choices(common, k=4000), *(["wretch"] if i % 2 else [])]), i % 2) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    assert min(len(text) for _, text, _ in rows) > 20_000
    for words in (4_000, 280):
        scored = toxicity.toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True), max_words=words).collect()
        right = sum((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in scored)
        assert right >= (57 if words == 4_000 else 30)


def test_rows_of_one_class_or_none(spark):
    frame = spark.createDataFrame([(i, f"word{i} some text", 1) for i in range(12)] + [(None, None, 0), (99, "", None)], "doc_id long, text string, toxic int")
    for labels in (frame, frame.where("toxic = 1"), frame.where("toxic is null"), frame.limit(0)):
        scores = toxicity.toxicity(frame.select("doc_id", "text"), labels.select("doc_id", "toxic"), F.lit(True)).collect()
        assert len(scores) == 14 and all(0 <= r["score"] <= 1 for r in scores)


def test_models_spell_out_few_words_at_once():
    draw = random.Random(3)
    stems = [bytes(draw.choices(b"abcdefghijklmnop", k=5)) for _ in range(300)]
    words = sorted({a + b for a in stems for b in stems})
    weights = [np.array([draw.randint(0, 3) for _ in words], dtype=float) for _ in range(2)]
    keys, owner = toxicity._padded(words)
    whole, back = np.unique(keys, return_inverse=True)
    tracemalloc.start()
    grams, counts = toxicity._counted(words, tuple(weights))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (grams == whole).all()
    assert all((c == np.bincount(back, weights=w[owner])).all() for c, w in zip(counts, weights))
    # One array of all n-grams, spelled out with their lead, is 16 * 8 bytes a word; at once, several of them were held.
    assert most < 3 * 16 * 8 * len(words)


def test_tasks_give_back_what_they_held(monkeypatch):
    class Held:
        pass

    seen = []

    def run(batches):
        held = Held()
        seen.append(weakref.ref(held))
        yield from batches

    monkeypatch.setattr(words_of_texts, "give_back", lambda: seen.append(seen[0]()))
    assert list(words_of_texts.giving_back(run)(iter([1, 2]))) == [1, 2]
    assert len(seen) == 2 and seen[1] is None


def test_a_large_model_is_broadcast_beside_the_function(spark, monkeypatch):
    draw = random.Random(9)
    rows = [(i, " ".join("".join(draw.choices("abcdefghijklmnop", k=8)) for _ in range(200)), i % 2) for i in range(100)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    sent = []
    monkeypatch.setattr(toxicity, "giving_back", lambda run: sent.append(run) or words_of_texts.giving_back(run))
    scored = toxicity.toxicity(frame.select("doc_id", "text"), frame.select("doc_id", "toxic"), F.lit(True))
    assert len(CloudPickleSerializer().dumps(sent[-1])) < 100_000
    spark.sparkContext._pickled_broadcast_vars.clear()
    # 20,000 words of 8 letters make a model of some megabytes, and it is used.
    assert all((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in scored.collect())


@pytest.mark.parametrize("operator", ["toxicity", "near copies", "contamination", "packing"])
def test_texts_go_to_python_in_bounded_batches(spark, operator):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 4000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("some words "), 500).alias("text"))
    few = texts.limit(4)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    run = {
        "toxicity": lambda: toxicity.toxicity(few, few.select("doc_id", F.lit(1).alias("toxic")), F.lit(True)),
        "near copies": lambda: minhash.near_duplicates(few),
        "contamination": lambda: decontaminate.contamination(few, few.withColumnRenamed("doc_id", "item_id")),
        "packing": lambda: packing.packed(few, tokenizer()),
    }[operator]
    try:
        for own, most in ((None, 4 << 20), ("1m", 1 << 20), ("1g", 4 << 20)):
            spark.conf.unset(key) if own is None else spark.conf.set(key, own)
            run()
            found = [r["n"] for r in texts.mapInArrow(sizes, "n long").collect()]
            assert sum(found) > 20_000_000 and max(found) < most + 20_000
    finally:
        spark.conf.unset(key)


def test_personal_data_starts_no_python_for_its_numbers(spark, monkeypatch):
    made = []
    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, data, *a, f=type(spark).createDataFrame, **b: made.append(data) or f(self, data, *a, **b))
    for text, n in (("write to ann@example.org or +1 415 555 0100", 2), ("nothing", 0)):
        found = personal.personal_spans(spark.range(1).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")))
        assert [len(r["spans"]) for r in found.collect()] == [n]
    assert len(made) == 2 and all(isinstance(data, pa.Table) for data in made)


def test_hashing_holds_few_bytes_at_once(monkeypatch):
    draw = random.Random(4)
    blobs = [" ".join("".join(draw.choices("abcdé", k=5)) for _ in range(400)).encode() for _ in range(1200)]
    for name in ("up", "down"):
        monkeypatch.setattr(words_of_texts._Powers, name, np.ones(1, dtype=np.uint64))
    tracemalloc.start()
    found = [words_of_texts.Words(blobs[lo:hi]).hashes() for lo, hi in words_of_texts.chunks(blobs)]
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    # Before: 32 MB of powers in each process, 64 MB while they were made.
    assert held < 20 << 20 and most < 32 << 20
    # A word's hash does not depend on what stands before it, nor on how long the tables are.
    alone = [words_of_texts.Words([blob]).hashes() for blob in blobs]
    assert (np.concatenate(found) == np.concatenate(alone)).all()
    long = b" ".join(blobs) * 2
    assert len(long) > words_of_texts._KEPT and (words_of_texts.Words([long]).hashes()[: len(alone[0])] == alone[0]).all()
    assert len(words_of_texts._Powers.up) <= words_of_texts._KEPT
