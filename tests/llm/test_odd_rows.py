"""Nulls, empty and very long texts, repeated rows, empty tables and clashing column names, for every operator and stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidyloom.llm import decontaminate, interpolation, minhash, near_vectors, packing, personal, queries, quotes, redirects, suffixes, toxicity

EXTRA = "id string, row string, n long, block long, band string, spans string, score string, group string, kept string, node string, value string, n_chars long"
_EXTRA = ("x", None, 1, 2, "b", "s", "0", "g", "k", "n", "v", 3)
LONG = "word " * 40_000 + "a@b.co"
ROWS = [(1, "same text of a few words a@b.co"), (1, "same text of a few words a@b.co"), (2, "same text of a few words a@b.co"), (3, None), (4, ""), (5, " \n\t "), (None, "no id here"), (None, None), (6, LONG), (7, LONG)]
IDS = sorted(str(r[0]) for r in ROWS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(d, t, *_EXTRA) for d, t in ROWS], f"doc_id long, text string, {EXTRA}")


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1), (2, 0), (6, 0), (None, 1), (3, None), (4, 7)], "doc_id long, toxic long")


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, "same text of a few words"), (2, None), (3, ""), (None, "of a few")], "item_id long, text string")


def ids(frame, column="doc_id"):
    return sorted(str(r[column]) for r in frame.collect())


def test_scores(docs, none):
    found = interpolation.interpolated_scores(docs, F.col("doc_id") != 2)
    assert ids(found) == IDS and all(r["score"] < 0 and r["n_tokens"] >= 1 for r in found.collect())
    assert interpolation.interpolated_scores(none, F.lit(True)).collect() == []
    assert ids(interpolation.interpolated_scores(docs, F.lit(False))) == IDS


def test_packing(docs, none):
    found = packing.packed(docs, queries.tokenizer()).collect()
    assert sorted({str(r["doc_id"]) for r in found}) == sorted(set(IDS))
    assert sum(r["length"] for r in found if r["doc_id"] == 3) == 1
    assert packing.packed(none, queries.tokenizer()).collect() == []


def test_personal(docs, none):
    found = personal.personal_spans(docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == IDS
    assert {(r["doc_id"], len(r["spans"])) for r in found} == {(1, 1), (2, 1), (3, 0), (4, 0), (5, 0), (None, 0), (6, 1), (7, 1)}
    assert personal.personal_spans(none).collect() == []


def test_near_copies(docs, none):
    found = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()}
    assert found == {(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (None, 1, None, True), (None, 0, None, True), (6, 2, 6, True), (7, 2, 6, False)}
    assert minhash.near_duplicates(none).collect() == []


def test_toxicity(docs, none, labels):
    found = toxicity.toxicity(docs, labels, F.lit(True))
    assert ids(found) == IDS and all(0 <= r["score"] <= 1 for r in found.collect())
    assert toxicity.toxicity(none, labels, F.lit(True)).collect() == []
    assert ids(toxicity.toxicity(docs, labels.limit(0), F.lit(True))) == IDS
    assert ids(toxicity.toxicity(docs, labels.where("toxic = 1"), F.lit(True))) == IDS


def test_repeats(docs, none):
    found = {(r["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"])) for r in suffixes.without_repeats(docs).collect()}
    # A long run of one word repeats itself from its second word on.
    assert {f[:2] for f in found} == {(1, 31), (2, 31), (3, 0), (4, 0), (5, 4), (None, 10), (None, 0), (6, 200_006), (7, 200_006)}
    assert {f[2] for f in found if f[0] == 7} == {200_006} and {f[2] for f in found if f[0] in (1, 2, 3, None)} == {0}
    assert suffixes.without_repeats(none).collect() == []


def test_contamination(docs, none, benchmark):
    found = decontaminate.contamination(docs, benchmark).collect()
    assert sorted(str(r["doc_id"]) for r in found) == IDS
    assert {(r["n_hit"], tuple(r["items"])) for r in found if r["doc_id"] == 1} == {(6, (1,))}
    assert decontaminate.contamination(none, benchmark).collect() == []
    assert all(r["n_hit"] == 0 for r in decontaminate.contamination(docs, benchmark.limit(0)).collect())


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [float("nan"), 1.0]), (8, [float("inf"), 1.0]), (None, [1.0, 0.0]), (9, [1.0]), (10, [1e-30, 1e-37])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, node string")
    found = sorted((tuple(r) for r in near_vectors.linked_vectors(frame).collect()), key=str)
    expected = [(1, 3, 1, True), (10, 3, 1, False), (2, 3, 1, False), (2, 3, 1, False), *((i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9)), (None, 0, None, True)]
    assert found == sorted(expected, key=str)
    assert near_vectors.linked_vectors(frame.limit(0)).collect() == []


def test_quotes_of_nothing(spark):
    frame = spark.createDataFrame([(1, None, "u", "> a"), (None, None, None, None)], "conv_id long, turn long, role string, text string")
    assert sorted(r["n_quotes"] for r in quotes.linked_conversations(frame).collect()) == [0, 1]
    assert quotes.linked_conversations(frame.limit(0)).collect() == []


def test_pages(spark):
    frame = spark.createDataFrame([(None, None, None, "h"), (1, "http://a.net/", None, "h"), (1, "http://a.net/", None, "h"), (2, "", "", "h")], "page_id long, url string, html string, host string")
    assert sorted(str((r["page_id"], r["verdict"])) for r in redirects.judged(frame, queries.PAGE_RULES).collect()) == ["(1, 'block')", "(1, 'block')", "(2, 'allow')", "(None, 'allow')"]
    assert redirects.judged(frame.limit(0), queries.PAGE_RULES).collect() == []


def test_stages(spark, docs, none, labels, benchmark, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).collect() == []
        found = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert found.columns == docs.columns
    kept = corpus_pipeline.without_near_copies(spark, docs, str(tmp_path))
    assert ids(kept) == sorted(["1", "3", "4", "5", "6", "None", "None"])
    masked = corpus_pipeline.without_personal_data(spark, docs, str(tmp_path)).where("doc_id = 1").first()
    assert (masked["text"], masked["n_chars"]) == ("same text of a few words <EMAIL>", 32)
