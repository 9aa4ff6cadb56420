"""Benchmark decontamination: test windows in a broadcast hash set, training windows scanned against it.

The windows of the benchmark are counted before they are broadcast. A benchmark
beyond the bound is joined by shuffle on window hashes instead; both ways end
in the same comparison of the words themselves.
"""

from __future__ import annotations

import bisect
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from tidyloom.llm.store import bounded_batches, saved
from tidyloom.llm.words import ALNUM_SEPARATED, Words, chunks, giving_back, shingles, sliced

WINDOW = 13
#: Benchmark windows that are broadcast at most (about 200 bytes each in a task).
BROADCAST_WINDOWS = 200_000


def _windows_of(size: int):
    """The distinct windows of each item: hash, number of words, the words themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for item, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = Words([blob or b""], ALNUM_SEPARATED)
                n = min(size, len(words.starts))
                found = {}
                for i, key in enumerate(shingles(words.hashes(), size).view(np.int64).tolist()):
                    found[b" ".join(words.word(i + k) for k in range(n))] = key
                keys, texts = list(found.values()), list(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(keys), batch.column(0).type), pa.array(keys, pa.int64()), pa.array([n] * len(keys), pa.int32()), pa.array(texts, pa.binary())],
                    names=["item", "key", "size", "words"],
                )

    return run


def _scan(items_of_window: list[tuple[int, int, bytes, list]], item_type: pa.DataType):
    """Hits in each text against a set of windows held whole: words, word ranges, items."""
    sets: dict[int, tuple] = {}
    for size in sorted({w[1] for w in items_of_window}):
        found = defaultdict(list)
        for key, n, words, items in items_of_window:
            if n == size:
                found[key].append((words, items))
        sets[size] = np.sort(np.fromiter(found, dtype=np.int64, count=len(found))), dict(found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            blobs = [b or b"" for b in batch.column("text").to_pylist()]
            rows = []
            for lo, hi in chunks(blobs):
                words = Words(blobs[lo:hi], ALNUM_SEPARATED)
                hits = _hits(words, sets)
                for i in range(hi - lo):
                    first, end = int(words.ranges[i]), int(words.ranges[i + 1])
                    rows.append(_summary(words, i, hits[bisect.bisect_left(hits, (first,)) : bisect.bisect_left(hits, (end,))]) | {"n_words": end - first})
            yield _batch(batch, rows, item_type)

    return run


def _hits(words: Words, sets: dict) -> list[tuple[int, int, list]]:
    """(first word, words, items) of every verified window, by place."""
    hashes, ends, out = words.hashes(), words.ranges[1:], []
    for size, (keys, found) in sets.items():
        if len(hashes) < size:
            continue
        windows = shingles(hashes, size).view(np.int64)
        slot = np.minimum(np.searchsorted(keys, windows), len(keys) - 1)
        for i in np.flatnonzero(keys[slot] == windows).tolist():
            if i + size > ends[np.searchsorted(ends, i, side="right")]:
                continue  # it would run into the next text
            text = b" ".join(words.word(i + k) for k in range(size))
            out += [(i, size, items) for own, items in found[int(windows[i])] if own == text]
    return sorted(out, key=lambda hit: hit[:2])


def _summary(words: Words, text: int, hits: list[tuple[int, int, list]]) -> dict:
    """Number of hit words, byte spans of hit runs, items."""
    spans: list[list[int]] = []
    for first, size, _ in hits:
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], first + size)
        else:
            spans.append([first, first + size])
    base = int(words.places[text])
    return {
        "n_hit": sum(b - a for a, b in spans),
        "spans": [{"start": int(words.starts[a]) - base, "end": int(words.ends[b - 1]) - base} for a, b in spans],
        "items": sorted({item for hit in hits for item in hit[2]}),
    }


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _batch(batch: pa.RecordBatch, rows: list[dict], item_type: pa.DataType) -> pa.RecordBatch:
    kept = [name for name in batch.schema.names if name != "text"]
    return pa.RecordBatch.from_arrays(
        [
            *(batch.column(name) for name in kept),
            pa.array([r["n_words"] for r in rows], pa.int64()),
            pa.array([r["n_hit"] for r in rows], pa.int64()),
            pa.array([r["spans"] for r in rows], _SPANS),
            pa.array([r["items"] for r in rows], pa.list_(item_type)),
        ],
        names=[*kept, "n_words", "n_hit", "spans", "items"],
    )


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    broadcast_windows: int = BROADCAST_WINDOWS,
    carry: str | None = None,
) -> DataFrame:
    """The id, ``n_words``, ``n_hit``, ``spans`` (hit byte ranges), ``items`` and the column ``carry`` for every row of ``documents``.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z in
    lower case. An item's windows are its runs of ``window`` words; a shorter
    item is one window. A document word inside any occurrence of a window is
    hit, and touching hit ranges are one span.

    Defined cases: null and empty texts have no words, no hit and no items;
    items without words are never found; items with one text are each reported;
    a null item id stands for no item, though its windows are hit; an empty benchmark hits
    nothing; repeated rows are each returned. Other columns are ignored.
    """
    bounded_batches(documents.sparkSession)
    items = benchmark.select(F.col(item_column).alias("item"), F.col(item_text_column).cast("binary").alias("text"))
    kind = items.schema["item"].dataType.simpleString()
    windows = saved(items.mapInArrow(_windows_of(window), f"item {kind}, key long, size int, words binary"), "windows")
    carried = [F.col(carry).alias("carried")] if carry else []
    source = documents.select(F.col(id_column).alias("id"), *carried, F.col(text_column).cast("binary").alias("text"))
    found = StructType.fromDDL(f"n_words long, n_hit long, spans array<struct<start:long,end:long>>, items array<{kind}>")
    schema = StructType([*source.schema.fields[:-1], *found.fields])
    arrow_kind = to_arrow_type(items.schema["item"].dataType)
    if windows.count() <= broadcast_windows:
        held = defaultdict(set)
        for row in windows.toLocalIterator():
            held[(row["key"], row["size"], bytes(row["words"]))].add(row["item"])
        listed = [(*key, sorted(x for x in found if x is not None)) for key, found in held.items()]
        out = source.mapInArrow(giving_back(_scan(listed, arrow_kind)), schema)
    else:
        out = _by_join(source, windows, schema, arrow_kind)
    return out.withColumnsRenamed({"id": id_column, **({"carried": carry} if carry else {})})


def _by_join(source: DataFrame, windows: DataFrame, schema: StructType, item_type: pa.DataType) -> DataFrame:
    """The same for a benchmark of any size: hashes of document windows meet benchmark windows in a shuffle.

    A document row goes out with its distinct window hashes; only windows that
    the benchmark has come back to it, and the words are compared there.
    """
    sizes = [row["size"] for row in windows.select("size").distinct().collect()]  # at most ``window`` numbers

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for row, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                hashes = Words([blob or b""], ALNUM_SEPARATED).hashes()
                found = [shingles(hashes, n).view(np.int64) for n in sizes if n <= len(hashes)]
                unique = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(unique), row, dtype=np.int64)), pa.array(unique)], names=["row", "key"])

    numbered = saved(source.withColumn("row", F.monotonically_increasing_id()), "numbered")
    pairs = numbered.select("row", "text").mapInArrow(keys, "row long, key long")
    met = pairs.join(windows.select("key").distinct(), "key")
    met = met.join(windows, "key").select("row", "item", "key", "size", "words")

    def compare(key, left: pa.Table, right: pa.Table) -> pa.Table:
        held = defaultdict(set)
        for item, k, n, words in zip(*(right.column(c).to_pylist() for c in ("item", "key", "size", "words"))):
            held[(k, n, words)].add(item)
        listed = [(*k, sorted(x for x in found if x is not None)) for k, found in held.items()]
        rows = left.drop(["row"]).combine_chunks().to_batches()
        return pa.Table.from_batches(list(_scan(listed, item_type)(iter(rows))))

    return numbered.groupBy("row").cogroup(met.groupBy("row")).applyInArrow(compare, schema)


def without_spans(text_column: str = "text", spans_column: str = "spans"):
    """The text without the hit byte ranges, as a column."""
    raw = F.col(text_column).cast("binary")
    ends = F.transform(spans_column, lambda s: s["end"])
    begins = F.concat(F.array(F.lit(0).cast("long")), ends)
    stops = F.concat(F.transform(spans_column, lambda s: s["start"]), F.array(F.octet_length(raw).cast("long")))
    parts = F.zip_with(begins, stops, lambda a, b: F.substring(raw, (a + 1).cast("int"), (b - a).cast("int")).cast("string"))
    return F.when(F.size(spans_column) > 0, F.concat_ws("", parts)).otherwise(F.col(text_column))
