"""Hierarchical packing: documents go to tiers of several window sizes, and gaps in long windows are filled from shorter tiers.

A document is cut into full windows of the largest tier; its rest goes to the
smallest tier that holds it. A rest opens a window of its tier, which is then
filled with the longest rests of shorter tiers that fit, and at last with a cut
piece, so a window is full unless a task has run out of documents. Windows are
powers of two; so only the last window of a task needs padding. Windows of
one tier that follow each other form a step group of equal tokens.

Each task packs the documents it reads, from a buffer of bounded tokens. There
is no shuffle and nothing is stored; a lost task is simply run again.
"""

from __future__ import annotations

import bisect
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

from tidyloom.llm.store import bounded_batches
from tidyloom.llm.words import giving_back, sliced

TIERS = (256, 512, 1024, 2048)
END = 1
#: Tokens of a step group, tokens that wait in a task before the longest are packed, distinct words whose ids a task remembers.
STEP_TOKENS, BUFFER_TOKENS, CACHED_WORDS = 32 * 2048, 1 << 20, 150_000

# How the byte-level step writes each byte: printable ones as themselves, the others from 256 on.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_OTHERS = [b for b in range(256) if b not in _PLAIN]
_AS_CHARACTER = {b: chr(b if b in _PLAIN else 256 + _OTHERS.index(b)) for b in range(256)}


class Encoder:
    """Token ids of texts as little-endian 32-bit integers.

    The tokenizer never joins across a blank or line end, so ids are looked up
    word by word. A new word of letters up to U+00FF, with or without a full
    stop or comma behind it, is one or two units of the tokenizer and goes
    straight to its merges; any other new word goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {"": b""}
        self.before: dict[str, bytes] = {}  # what was known before the last clearing: common words come back from it
        self.marks = {mark: self._whole(mark) for mark in (".", ",")}

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _new(self, word: str) -> bytes:
        found = self.known.get(word) or self.before.get(word)
        if found is not None:
            self.known[word] = found
            return found
        mark = self.marks.get(word[-1])
        stem = word if mark is None else word[:-1]
        if stem.isalpha() and max(stem) <= "\u00ff":
            stem = stem.lower()
            found = self.known.get(stem) or self.before.get(stem)
            if found is None:
                unit = stem if stem.isascii() else "".join(map(_AS_CHARACTER.__getitem__, stem.encode()))
                found = self.known[stem] = b"".join([token.id.to_bytes(4, "little") for token in self.model.tokenize(unit)])
            if mark is not None:
                found += mark
        else:
            found = self._whole(word)
        self.known[word] = found
        return found

    def ids(self, text: str) -> bytes:
        words = text.replace("\n", " ").split(" ")
        if len(self.known) > CACHED_WORDS:
            self.known, self.before = {"": b""}, self.known
        found = list(map(self.known.get, words))
        if None in found:
            new = self._new
            found = [ids if ids is not None else new(word) for ids, word in zip(found, words)]
        return b"".join(found)


class Packer:
    """Pieces of windows: (document, start, ids, window number, offset, tier, step group)."""

    def __init__(self, tiers: tuple[int, ...], first_window: int, step_tokens: int, buffer_tokens: int):
        self.tiers, self.buffer, self.step_tokens = tiers, buffer_tokens, step_tokens
        self.window, self.waiting, self.held, self.order = first_window, [], 0, 0  # waiting: (length, order, document, start, ids), by length
        self.step_first, self.steps, self.fill = first_window, 0, {t: (0, 0) for t in tiers}
        self.out: list[tuple] = []

    def add(self, document, ids: bytes) -> None:
        top = self.tiers[-1] * 4
        whole = len(ids) // top * top
        for at in range(0, whole, top):
            self._close([(document, at // 4, ids[at : at + top])], self.tiers[-1])
        if len(ids) > whole:
            self._wait(document, whole // 4, ids[whole:])
        if self.held > self.buffer:
            self.pack(self.buffer // 2)

    def _wait(self, document, start: int, ids: bytes) -> None:
        self.order += 1
        bisect.insort(self.waiting, (len(ids) // 4, self.order, document, start, ids), key=lambda x: x[:2])
        self.held += len(ids) // 4

    def _take(self, i: int) -> tuple:
        found = self.waiting.pop(i)
        self.held -= found[0]
        return found

    def pack(self, rest: int = 0) -> None:
        """Make windows, the longest documents first, until at most ``rest`` tokens wait."""
        while self.waiting and self.held > rest:
            length, _, document, start, ids = self._take(-1)
            tier = next(t for t in self.tiers if length <= t)
            parts, gap = [(document, start, ids)], tier - length
            while gap and self.waiting:
                i = bisect.bisect_right(self.waiting, gap, key=lambda x: x[0])
                n, _, document, start, ids = self._take(i - 1 if i else 0)  # the longest that fits, else the shortest, cut
                parts.append((document, start, ids[: gap * 4]))
                if n > gap:
                    self._wait(document, start + gap, ids[gap * 4 :])
                gap -= min(n, gap)
            self._close(parts, tier)

    def _close(self, parts: list[tuple], tier: int) -> None:
        step, tokens = self.fill[tier]
        if tokens % self.step_tokens == 0:
            step, self.steps = self.step_first + self.steps, self.steps + 1
        self.fill[tier] = step, tokens + tier
        offset = 0
        for document, start, ids in parts:
            self.out.append((document, start, ids, self.window, offset, tier, step))
            offset += len(ids) // 4
        self.window += 1


def _packed(path: str, tiers: tuple[int, ...], step_tokens: int, buffer_tokens: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        packer = Packer(tiers, TaskContext.get().partitionId() << 33, step_tokens, buffer_tokens)
        end, totals = np.array([END], dtype="<u4").tobytes(), {}

        def rows() -> pa.RecordBatch:
            columns = list(zip(*((*o[0], *o[1:]) for o in packer.out)))
            packer.out = []
            document, total, start, ids, window, offset, tier, step = columns
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(document, id_type),
                    pa.array(start, pa.int64()),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array(total, pa.int64()),
                    pa.array(window, pa.int64()),
                    pa.array(offset, pa.int64()),
                    pa.array(tier, pa.int32()),
                    pa.array(step, pa.int64()),
                ],
                names=["id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_id"],
            )

        for batch in sliced(batches):
            for document, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encoder.ids(text or "") + end
                packer.add((document, len(ids) // 4), ids)
                if len(packer.out) > 2000:
                    yield rows()
        packer.pack()
        if packer.out:
            yield rows()

    return run


def packed(
    documents: DataFrame,
    tokenizer_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    tiers: tuple[int, ...] = TIERS,
    step_tokens: int = STEP_TOKENS,
    buffer_tokens: int = BUFFER_TOKENS,
) -> DataFrame:
    """Pieces of documents in windows of tokens; one row for each piece.

    Columns: the id, ``start`` and ``length`` in the document's ids, ``ids``
    (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id``,
    ``offset`` in the sequence, ``tier`` (the window's size) and ``step_id``
    (windows of one tier with ``step_tokens`` tokens together; the last group of
    a tier in a task may be smaller). Every id of every document, its closing
    id included, is in exactly one piece.

    Defined cases: a null or empty text is its closing id alone; repeated rows
    are each packed; a null id is kept; an empty table gives no sequence.
    Other columns are ignored.
    """
    bounded_batches(documents.sparkSession)
    source = documents.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    kind = source.schema["id"].dataType
    names = ("start", "length", "ids", "doc_tokens", "sequence_id", "offset", "tier", "step_id")
    kinds = {"ids": BinaryType(), "tier": IntegerType()}
    schema = StructType([StructField("id", kind), *(StructField(n, kinds.get(n, LongType())) for n in names)])
    tiers = tuple(sorted(tiers))
    pack = giving_back(_packed(tokenizer_path, tiers, step_tokens, buffer_tokens, to_arrow_type(kind)))
    return source.mapInArrow(pack, schema).withColumnRenamed("id", id_column)
