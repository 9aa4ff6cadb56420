"""Token counts of whole texts, however long, by overlapping chunks that are joined where their tokens agree.

A text of up to ``chunk_chars`` code points is encoded at once. A longer one is
encoded in chunks: the next chunk starts at a token of the one before, so far
from that chunk's end as the overlap asks, and the two are joined at the first
token that both have at one place.

Why that is right: byte-pair merges take the pair of highest score, leftmost
first. Look at a border between two neighbouring tokens. Merges on its two sides
run in the same order whether or not other text stands around them, so a list of
tokens is the encoding of its text exactly if each pair of neighbours is the
encoding of the pair's text. With a token that both chunks have at one place,
each pair of neighbours in the joined list stands in one of the two chunks. The
cut end of a chunk and the start of the next may be encoded wrongly; no token is
taken from there, because left of the common token the earlier chunk counts, and
right of it the later one.

Where the overlap has no common token it is doubled, at last back to the start of
the text, where the encoding is the text's own.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import LongType, StructField, StructType

from tidyloom.llm.words import sliced

CHUNK_CHARS, OVERLAP_CHARS = 1 << 16, 256
_BLANK = "▁"


class Counter:
    """Counts tokens with one sentencepiece model; ``widened`` counts overlaps that had to grow."""

    def __init__(self, path: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.chunk, self.overlap, self.widened = max(chunk_chars, 1), max(overlap_chars, 1), 0
        ids = range(self.model.get_piece_size())
        pieces = [self.model.id_to_piece(i) for i in ids]
        # Code points for which a token stands; of a character written in bytes, the first byte stands for all.
        self.lengths = np.array(
            [int(not 0x80 <= int(p[3:5], 16) < 0xC0) if self.model.is_byte(i) else len(p) for i, p in zip(ids, pieces)], dtype=np.int64
        )
        # A character in no longer piece: nothing merges across it.
        self.guard = next(c for c in map(chr, (10, *range(1, 32))) if not any(c in p for p in pieces))
        self.guard_tokens = len(self.model.encode(self.guard))

    def tokens(self, text: str, first: int, end: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of ``text[first:end]`` and the places where they begin; None if a token's place is not known."""
        if first:
            ids = self.model.encode(self.guard + text[first:end])[self.guard_tokens :]
        else:
            ids = self.model.encode(text[:end])
        ids = np.array(ids, dtype=np.int64)
        ends = np.cumsum(self.lengths[ids])
        added = int(ends[-1]) - (end - first) if len(ids) else 0  # the blank that the model puts before a text
        if added not in ((0, 1) if not first else (0,)):
            return None
        return ids, ends - self.lengths[ids] + first - added

    def count(self, text: str) -> int:
        if len(text) <= self.chunk:
            return len(self.model.encode(text))
        text = text.replace(_BLANK, " ")  # to the model they are one character
        first, end, counted = 0, self.chunk, 0
        held = self.tokens(text, 0, end)
        while held is not None and end < len(text):
            ids, places = held
            overlap, further = self.overlap, min(end + self.chunk, len(text))
            while True:
                # The next chunk starts at a token; -1 is the blank before the text.
                at = np.searchsorted(places, max(end - overlap, first), side="right") - 1
                start = max(int(places[at]), 0) if end - overlap > first else first
                following = self.tokens(text, start, further)
                if following is None:
                    held = None
                    break
                common = self._common(held, following)
                if common is not None:
                    counted += common[0]
                    held, first, end = (following[0][common[1] :], following[1][common[1] :]), int(following[1][common[1]]), further
                    break
                self.widened += 1
                if end - overlap <= first:  # all that is held has been tried: once more from the start of the text
                    held, first, end, counted = self.tokens(text, 0, further), 0, further, 0
                    break
                overlap *= 2
        return len(self.model.encode(text)) if held is None else counted + len(held[0])

    def _common(self, left: tuple, right: tuple) -> tuple[int, int] | None:
        """Index, in both lists, of the first token that they have at one place."""
        key = [places[self.lengths[ids] > 0] * len(self.lengths) + ids[self.lengths[ids] > 0] for ids, places in (left, right)]
        index = [np.flatnonzero(self.lengths[ids] > 0) for ids, _ in (left, right)]
        _, i, j = np.intersect1d(*key, assume_unique=True, return_indices=True)
        return (int(index[0][i[0]]), int(index[1][j[0]])) if len(i) else None


def _counted(path: str, chunk_chars: int, overlap_chars: int, id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, chunk_chars, overlap_chars)
        for batch in sliced(batches, 128):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            short = [text for text in texts if len(text) <= chunk_chars]
            lengths = iter([len(ids) for ids in counter.model.encode(short, num_threads=1)])
            counts, widened = [], []
            for text in texts:
                before = counter.widened
                counts.append(next(lengths) if len(text) <= chunk_chars else counter.count(text))
                widened.append(counter.widened - before)
            columns = [batch.column(0).cast(id_type), batch.column(2), pa.array(counts, pa.int64()), pa.array(widened, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_bytes", "n_tokens", "n_widened"])

    return run


def token_counts(
    documents: DataFrame,
    model_path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """Bytes and tokens of every whole text; one row for each row of ``documents``.

    Columns: the id, ``n_bytes`` (UTF-8), ``n_tokens`` as the sentencepiece model
    gives them for the whole text (no begin or end token; the strings of special
    tokens are ordinary text), and ``n_widened``, how often an overlap had to grow.
    One pass without a shuffle; a task holds a few texts and the ids of one chunk.

    Defined cases: a null or empty text has 0 bytes and 0 tokens; a text of any
    length is counted whole; repeated rows and ties are counted row by row; a null
    id is kept; an empty table gives no row. Other columns, whatever their
    names, are ignored. A model that rewrites texts before it
    encodes them gives no places: such long texts are encoded at once.
    """
    if not os.path.exists(model_path):
        raise FileNotFoundError(model_path)
    text = F.col(text_column)
    source = documents.select(F.col(id_column).alias("id"), text.alias("text"), F.octet_length(F.coalesce(text, F.lit(""))).cast("long").alias("n_bytes"))
    kind = source.schema["id"].dataType
    schema = StructType([StructField("id", kind), *(StructField(n, LongType()) for n in ("n_bytes", "n_tokens", "n_widened"))])
    return source.mapInArrow(_counted(model_path, chunk_chars, overlap_chars, to_arrow_type(kind)), schema).withColumnRenamed("id", id_column)
