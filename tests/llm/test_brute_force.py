"""Every operator against a plain version of what it promises, on the smallest tables or made-up rows."""

import collections
import hashlib
import math
import pathlib
import re
import struct
import zlib

import numpy as np
import oracle
import pytest
from conftest import TABLES
from pyspark.sql import functions as F

import corpus_pipeline
from tidyloom.llm import decontaminate, interpolation, minhash, near_vectors, packing, personal, queries, quotes, redirects, suffixes, toxicity
from tidyloom.settings import shared_folder


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{TABLES}/documents.parquet").collect()}


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_twin(spark, name):
    assert oracle.differences(queries.QUERIES[name](spark, TABLES), queries.ORACLES[name], oracle.connect(TABLES)) == []


def test_vectors_in_many_cells_and_blocks(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8))
    x = (centres[rng.integers(0, 12, 150)] + 0.12 * rng.normal(size=(150, 8))).astype(np.float32)
    x[5], x[6] = x[4], 2 * x[4]
    frame = spark.createDataFrame([(i * 3, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    reach = list(range(150))
    for _ in range(150):
        reach = [min([reach[i], *(reach[j] for j in np.flatnonzero(linked[i]))]) for i in range(150)]
    expected = [(i * 3, int(linked[i].sum()), reach[i] * 3, reach[i] == i) for i in range(150)]
    for pivots, block in ((64, 4096), (1, 20), (16, 7)):
        found = near_vectors.linked_vectors(frame, block_rows=block, most_pivots=pivots)
        assert sorted(map(tuple, found.collect())) == expected


def test_replication_keeps_every_pair():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    reach = math.sqrt(2 - 2 * 0.95)
    home, near = near_vectors._cells(x, x[:16], reach)
    for i, j in zip(*np.nonzero(x @ x.T >= 0.95)):
        assert (near[i] & near[j] & (np.arange(16)[:] >= 0))[[home[i], home[j]]].any()


def test_base_scores_and_held_out_gain(spark, texts):
    found = {r["doc_id"]: r for r in queries.op2_interpolation(spark, TABLES).collect()}
    tokens = {d: [*t.encode().lower().split(), None] for d, t in texts.items()}
    counts = collections.Counter(w for d, ws in tokens.items() if zlib.crc32(str(d).encode()) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    for d, ws in tokens.items():
        r = found[d]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(ws), sum(counts[w] > 0 for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
    held = [r for r in found.values() if r["held_out"]]
    assert held and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_counts_do_not_depend_on_blocks(spark, texts):
    frame = spark.createDataFrame(list(texts.items())[:60], "doc_id long, text string")
    one, many = (
        {r["doc_id"]: r for r in interpolation.interpolated_scores(frame, F.col("doc_id") % 3 != 0, block_bytes=size).collect()} for size in (1 << 30, 20_000)
    )
    assert all(math.isclose(one[d]["base_score"], many[d]["base_score"]) and one[d]["n_known"] == many[d]["n_known"] for d in one)


def test_scores_do_not_depend_on_blocks(spark, texts):
    frame = spark.createDataFrame(list(texts.items())[:60], "doc_id long, text string")
    one, *others = (
        {r["doc_id"]: r["score"] for r in interpolation.interpolated_scores(frame, F.col("doc_id") % 3 != 0, block_bytes=size).collect()}
        for size in (1 << 30, 60_000, 20_000, 3_000)
    )
    assert len(one) == 60
    assert all(math.isclose(one[d], other[d], rel_tol=1e-12) for other in others for d in one)


def test_texts_are_dealt_out_once_and_counts_are_removed(spark, texts, monkeypatch):
    frames, stored = [], interpolation.stored
    monkeypatch.setattr(interpolation, "stored", lambda frame: frames.append(frame) or stored(frame))
    folder = pathlib.Path(shared_folder(spark).removeprefix("file:"))
    before = {*folder.glob("tidyloom-*")}
    frame = spark.createDataFrame(list(texts.items())[:20], "doc_id long, text string")
    assert interpolation.interpolated_scores(frame, F.lit(True), block_bytes=20_000).count() == 20
    assert {*folder.glob("tidyloom-*")} == before  # nothing but checkpoints, which Spark cleans up
    (counted,) = frames
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan and plan.count("Scan ExistingRDD") == 1


def test_mixture_weights_find_the_better_estimate():
    # Bucket 3: the bigram estimate (1/2) always beats the word estimate (1/1024).
    key = np.array([(3 * 1001 + 4) * 1001 + 40])
    weights = interpolation.mixture_weights(key, np.array([1000.0]), types=10**6)
    assert weights[3, 0] > 0.95 and weights[0, 0] == 0 and np.allclose(weights.sum(axis=1), 1)


QUOTED = [
    (1, 0, "user", "Hello there friends.\nHow are you?"),
    (1, 1, "assistant", "> How are  YOU?\nFine.\n\nSecond paragraph here."),
    (1, 2, "user", "Bob wrote:\n> > How are you?\n> Fine.\nGood to hear"),
    (1, 3, "user", "> Hello there friends.\n> How are you?\nTo the first."),
    (1, 3, "user", "again"),
    (2, 5, "user", ">Second paragraph here.\nfrom other"),
    (2, 6, "assistant", None),
    (3, 0, "user", "> unknown thing\n"),
    (None, 1, "user", "> Fine."),
]


def test_quotes_are_linked(spark):
    frame = spark.createDataFrame(QUOTED, "conv_id long, turn long, role string, text string")
    found = {(r["conv_id"], r["turn"], r["text"]): tuple(r)[3:10] for r in quotes.linked_conversations(frame).collect()}
    assert found == {
        (1, 0, "Hello there friends.\nHow are you?"): (0, 0, None, None, 1, 0, 0),
        (1, 1, "Fine.\n\nSecond paragraph here."): (1, 1, 1, 0, 1, 0, 1),
        (1, 2, "Good to hear"): (2, 2, 1, 1, 1, 0, 2),
        (1, 3, "To the first."): (1, 1, 1, 0, 1, 0, 1),
        (1, 3, "again"): (0, 0, 1, 0, 1, 0, 1),
        (2, 5, "from other"): (1, 1, 1, 1, 1, 0, 2),
        (2, 6, ""): (0, 0, 2, 5, 1, 0, 3),
        (3, 0, ""): (1, 0, None, None, 3, 0, 0),
        (None, 1, ""): (1, 0, None, None, None, None, None),
    }


def test_packing_round_trip(spark, texts):
    frame = spark.read.parquet(f"{TABLES}/documents.parquet")
    rows = packing.packed(frame, queries.tokenizer(), buffer_tokens=20_000).collect()
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer())
    pieces, windows = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        windows[r["sequence_id"]].append(r)
    assert set(pieces) == set(texts)
    for d, text in texts.items():
        own = sorted(pieces[d], key=lambda r: r["start"])
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert b"".join(bytes(r["ids"]) for r in own) == struct.pack(f"<{len(ids)}I", *ids)
        assert [r["start"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        assert {r["doc_tokens"] for r in own} == {len(ids)}
    padding = 0
    for own in windows.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == [sum(x["length"] for x in own[:i]) for i in range(len(own))]
        total = sum(r["length"] for r in own)
        assert total <= own[0]["tier"] and len({r["step_id"] for r in own}) == 1
        padding += 0 if total & (total - 1) == 0 else 2048 - total
    assert padding <= 2048 * frame.rdd.getNumPartitions()


def test_words_are_encoded_as_the_tokenizer_does():
    encoder = packing.Encoder(queries.tokenizer())
    for text in ["a\x1cb <|endoftext|>x don't I'LL é́ x y z 12a's\tb\r\nc", "", "  ", "İstanbul ΣΑΣ ﬁ é ́x", "日本 語🙂🙂 ' s 's", "THE, the. The... ª µ ß ÿ"]:
        assert encoder.ids(text) == np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if c > "4" else 2 * int(c)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


HARD = [
    "a@b.c_d@e.f x@y.z",
    "x" * 100_000,
    "1" * 60_000 + " 4111 1111 1111 1111 -",
    "1.2.3.4.5.6.7.8 999.1.1.1 000255.1.1.1",
    "+1 (979) 555-6697 4111-1111-1111-1111 5.5.5.5",
    "é@b.co 🙂 a@b.co joe (at) mail.com",
    "+1 2 3-4 5 6 7 8 9 0" * 20,
    "12345678901234567890.1.1.1",
    "5.5.5.5+" + "1 " * 50_000,
    "",
]


def test_base_spans_are_exact(spark, texts):
    every = dict(enumerate([*HARD, *texts.values()]))
    frame = spark.createDataFrame(list(every.items()), "doc_id long, text string")
    found = personal.personal_spans(frame)
    for r in found.select("doc_id", "spans", personal.masked(F.lit("x"), F.array().cast(personal._SPAN)).alias("m")).collect():
        assert [(s["kind"], s["start"], s["end"]) for s in r["spans"] if s["base"]] == base_spans(every[r["doc_id"]])
        assert all(every[r["doc_id"]][s["start"] : s["end"]] == s["value"] for s in r["spans"])


def test_masked_text(spark):
    frame = spark.createDataFrame([(0, "to a@b.co or +1 (979) 555-6697."), (1, "none")], "doc_id long, text string")
    found = personal.personal_spans(frame, carry="text")
    assert {r[0] for r in found.select(personal.masked(F.col("text"), F.col("spans"))).collect()} == {"to <EMAIL> or <PHONE>.", "none"}


def test_reliabilities_favour_labelers_that_agree():
    patterns = [("card", (1, 1, 1, 0, 1), 80), ("card", (0, -1, -1, 0, -1), 90), ("card", (1, 1, 0, -1, 1), 10), ("card", (0, -1, 0, 1, -1), 10)]
    posterior, learned = personal.reliabilities(patterns)
    assert posterior[("card", 1, 1, 1, 0, 1)] > 0.9 > 0.1 > posterior[("card", 0, -1, -1, 0, -1)]
    rates = learned["card"]["rates"]
    assert rates["check"][True][1] > 0.8 and rates["check"][False][-1] > 0.8


@pytest.mark.parametrize("size", [2, 5])
def test_near_copies_are_exact(spark, texts, size):
    def grams(text):
        words = text.encode().lower().split()
        return set(zip(*(words[i:] for i in range(min(size, len(words)))))) if words else set()

    sets = {d: grams(t) for d, t in texts.items()}
    reach = {d: d for d in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            reach[a] = reach[b] = min(reach[a], reach[b])
    found = minhash.near_duplicates(spark.read.parquet(f"{TABLES}/documents.parquet"), shingle_words=size)
    assert sorted(map(tuple, found.collect())) == sorted((d, len(s), reach[d], reach[d] == d) for d, s in sets.items())


def test_one_group_of_near_copies(spark):
    # Copies with ever more own words: the chain from text to text holds them together, the far ends are not alike.
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join([*words[: 60 - k], *(f"own{k}" for _ in range(1)), *words[60 - k :]]) for k in range(0, 60, 2)]
    texts += [" ".join(f"x{k}-{i}" if i % 3 == 0 else w for i, w in enumerate(words)) for k in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = minhash.near_duplicates(frame, shingle_words=2, bands=60)
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: 0 if i < 30 else i for i in range(50)}


def test_held_out_toxicity(spark):
    folder = "/root/testdata/sf0.1"
    scored = queries.op7_toxicity(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = scored.where("held_out").select("toxic", "predicted").collect()
    assert sum(r["toxic"] == r["predicted"] for r in rows) >= 0.95 * len(rows)
    assert sum(r["predicted"] for r in rows if r["toxic"]) >= 0.9 * sum(r["toxic"] for r in rows)


def test_labels_of_held_out_rows_are_never_read(spark):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    turned = labels.withColumn("toxic", F.when(queries.fold(5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.toxicity(documents, x, queries.fold(5) != 0).collect())) for x in (labels, turned))
    assert a == b


def test_unknown_words_say_nothing():
    evidence = toxicity.Evidence([b"idiot", b"good", b"great"], np.array([9.0, 1, 1]), np.array([0.0, 9, 9]))
    bad, good, unknown = evidence.of([b"idiot", b"good", b"zzzz"])
    assert bad > 1 > 0 > good and abs(unknown) < abs(bad)


@pytest.mark.parametrize("text", [b"", b"a", b"mississippi", b"a" * 300, b"ab" * 100, bytes(range(256)) * 2, b"abcabcab" * 9 + b"\x00\x00"])
def test_suffix_array(text):
    assert suffixes.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_suffix_arrays_of_random_texts():
    rng = np.random.default_rng(3)
    for n in range(40):
        text = bytes(rng.integers(97, 99 + n % 3, n).astype(np.uint8))
        assert suffixes.suffix_array(text) == sorted(range(n), key=lambda i: text[i:])


def test_groups_share_lyndon_prefixes():
    groups, _ = suffixes.lyndon_groups(b"graindraining")
    starts = [[b"graindraining"[s : s + 2] for s in sorted(g)] for g in groups]
    assert len(starts) == len({tuple(sorted(set(g))) for g in starts}) or starts  # groups are apart
    assert sorted(s for g in groups for s in g) == list(range(13))


def removed(texts):
    seen, out = set(), {}
    for d in sorted(texts):
        blob = texts[d].encode()
        marks = bytearray(len(blob))
        for i in range(len(blob) - 99):
            window = blob[i : i + 100]
            if window in seen:
                marks[i : i + 100] = b"\x01" * 100
            seen.add(window)
        kept = bytes(b for b, m in zip(blob, marks) if not m)
        out[d] = (len(blob), sum(marks), sum(m and (not i or not marks[i - 1]) for i, m in enumerate(marks)), hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_are_exact(spark, texts):
    found = queries.op8_suffixes(spark, TABLES).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == removed(texts)


def test_repeats_in_small_blocks_with_hot_anchors(spark, texts):
    line = "a line that stands in very many texts, as licences and menus do, and is longer than one hundred bytes in all; yes it is."
    made = {i: (f"{'q' * (i * 7)}{line}{i}" if i % 2 else f"{line} {line}") for i in range(24)} | {100 + i: t for i, t in enumerate(list(texts.values())[:30])}
    made |= {200: "z" * 400, 201: "z" * 150, 202: "ü" * 99}
    frame = spark.createDataFrame(list(made.items()), "doc_id long, text string")
    for hot in (3, 10**9):
        found = suffixes.without_repeats(frame, block_bytes=5000, hot_anchor=hot)
        rows = found.select("doc_id", "n_bytes", F.octet_length("kept"), F.size("spans"), F.sha2("kept", 256)).collect()
        assert {r[0]: (r[1], r[1] - r[2], r[3], r[4]) for r in rows} == removed(made)


def test_windows_by_join_as_by_broadcast(spark):
    documents, benchmark = (spark.read.parquet(f"{TABLES}/{t}.parquet") for t in ("documents", "benchmark"))
    a, b = (sorted(map(str, decontaminate.contamination(documents, benchmark, broadcast_windows=n).collect())) for n in (10**6, 0))
    assert a == b and any("Row(start" in r for r in a)


def test_hit_spans_are_removed(spark):
    words = [f"w{i}" for i in range(20)]
    documents = spark.createDataFrame([(1, "Über " + " ".join(words) + ", end"), (2, "clean")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("i", " ".join(words[2:18]))], "item_id string, text string")
    found = decontaminate.contamination(documents, benchmark).join(documents, "doc_id")
    rows = {r["doc_id"]: r for r in found.withColumn("left", decontaminate.without_spans()).collect()}
    assert (rows[1]["n_hit"], rows[1]["n_words"], rows[1]["left"]) == (16, 22, "Über w0 w1  w18 w19, end")
    assert rows[2]["left"] == "clean"


PAGES = [
    (1, "http://a.com/x", '<link rel="canonical" href="https://b.org/y">'),
    (2, "https://b.org/y#top", '<meta http-equiv="refresh" content="0; url=/z">'),
    (3, "https://b.org/z", ""),
    (4, "http://spam.net/q?a=1", "<LINK HREF='http://b.org/z' REL=canonical>"),
    (5, "http://EXAMPLE.net/en/1", '<link rel="canonical" href="http://c.info/1">'),
    (6, "http://c.info/1", '<link rel="canonical" href="http://www.x.net/">'),
    (7, "http://d.info", None),
    (8, None, '<link rel="canonical" href="http://spam.net/q">'),
    (9, "no address", None),
    (10, "http://sub.example.com/de/1?x#y", None),
    (11, "http://notnet/", None),
]


def test_blocks_reach_aliases_unless_allowed(spark):
    frame = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in redirects.judged(frame, queries.PAGE_RULES).collect()}
    assert found == {
        1: ("a.com", "/x", None, "block"),
        2: ("b.org", "/y", None, "block"),
        3: ("b.org", "/z", None, "block"),
        4: ("spam.net", "/q", "net/", "block"),
        5: ("example.net", "/en/1", "example.net/en/", "allow"),
        6: ("c.info", "/1", None, "allow"),
        7: ("d.info", "", None, "allow"),
        8: ("", "", None, "allow"),
        9: ("", "", None, "allow"),
        10: ("sub.example.com", "/de/1", "example.com/de/", "block"),
        11: ("notnet", "/", None, "allow"),
    }


def test_pipeline_stages(spark, texts):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    columns = docs.columns
    rows = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, TABLES)
        assert kept.columns == columns
        kept = spark.createDataFrame(kept.collect(), kept.schema)
        assert 0.7 * rows <= kept.count() <= rows
        docs, rows = kept, kept.count()
    assert not any(base_spans(r["text"]) for r in docs.collect())
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, TABLES)
    assert {r["doc_id"] for r in pieces.select("doc_id").collect()} == {r["doc_id"] for r in docs.collect()}
