"""Spelling variants: words that differ by one inserted, deleted or replaced letter, by dense tiles of code points.

Words of one length, and of one length and the next, are written as padded
matrices of code points. A tile compares every word of one block with every word
of another, column by column: the common prefix and the common suffix grow until
the letters differ. Two words are one edit apart exactly if prefix and suffix
together reach the longer length minus one.

One edit leaves the first or the second half of a word as it is, so only words
that share a half at the same end meet in tiles. A half that very many words
share is cut into blocks; each pair of blocks is a row of its own and goes to any
task. A tile sends, for each word, a count and its best neighbour, never the pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidyloom.llm.store import saved
from tidyloom.llm.words import sliced

#: Words of a block, letters of a block, distinct words that a task counts before it sends them.
BLOCK_WORDS, BLOCK_LETTERS, HELD_WORDS = 1024, 1 << 18, 300_000

# Latin-1 bytes: A-Z become a-z, U+00C0 to U+00FF stay, all else parts words.
_LETTERS = bytes(b if 97 <= b <= 122 or b >= 0xC0 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str) -> list[bytes]:
    """The runs of letters as UTF-8, only A-Z lower-cased."""
    return text.encode("latin-1", "replace").translate(_LETTERS).decode("latin-1").encode().split()


def _damaged(word: bytes, h: int) -> bytes:
    letters = word.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _counts(damage_every: int | None, held_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def rows() -> pa.RecordBatch:
            found = [(w, n) for w, n in counts.items() if w and n]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in found], pa.binary()).cast(pa.string()), pa.array([n for _, n in found], pa.int64())], names=["word", "n"]
            )

        for batch in sliced(batches, 64):
            for document, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text)
                counts.update(words)
                if damage_every:
                    base, crc32 = zlib.crc32(f"{document}:".encode()), zlib.crc32
                    for word in [w for w in set(words) if crc32(w, base) % damage_every == 0]:
                        n = words.count(word)
                        counts[word] -= n
                        counts[_damaged(word, crc32(word, base))] += n
                if len(counts) > held_words:
                    yield rows()
        if counts:
            yield rows()

    return run


def word_counts(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    damage_every: int | None = None,
    least_letters: int = 5,
    least_count: int = 3,
    held_words: int = HELD_WORDS,
) -> DataFrame:
    """``word`` and ``n`` of all words that are long and frequent enough; each task counts before the shuffle."""
    source = documents.where(F.col(text_column).isNotNull())
    source = source.select(F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("id"), F.col(text_column).alias("text"))
    partial = source.mapInArrow(_counts(damage_every, held_words), "word string, n long")
    # A word that is too short never counts, so it need not travel.
    total = partial.where(F.length("word") >= least_letters).groupBy("word").agg(F.sum("n").alias("n"))
    return total.where(F.col("n") >= least_count)


def tile(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of the pairs of rows that are one edit apart or equal; ``right`` has as many columns as ``left`` or one more."""
    short, long = left.shape[1], right.shape[1]
    kind = np.uint8 if 2 * long < 256 else np.int32
    reach = np.zeros((len(left), len(right)), dtype=kind)
    for columns in (zip(range(short), range(short)), zip(range(short - 1, -1, -1), range(long - 1, -1, -1))):  # prefix, then suffix
        alive = np.ones(reach.shape, dtype=bool)
        for a, b in columns:
            alive &= left[:, a, None] == right[None, :, b]
            if not alive.any():
                break
            reach += alive
    return np.nonzero(reach >= long - 1)


def matrix(words: Sequence[str], width: int) -> np.ndarray:
    """Code points of words, padded to ``width`` columns; one byte each where they fit."""
    padded = "".join(word.ljust(width, "\0") for word in words)
    try:
        flat = np.frombuffer(padded.encode("latin-1"), dtype=np.uint8)
    except UnicodeEncodeError:
        flat = np.frombuffer(padded.encode("utf-32-le"), dtype="<u4")
    return flat.reshape(len(words), width)


class _Side:
    """Words of one block and of one length, with counts, and what a tile finds for them."""

    def __init__(self, held: list[dict], length: int):
        found = [(h["word"], h["n"]) for h in held if len(h["word"]) == length]
        # By falling count, then by code points: the smallest index is the best near word.
        found.sort(key=lambda x: (-x[1], x[0]))
        self.words, self.n = [w for w, _ in found], [n for _, n in found]
        self.letters = matrix(self.words, length)

    def rows(self, mine: np.ndarray, theirs: np.ndarray, other: _Side) -> Iterator[tuple]:
        near = np.bincount(mine, minlength=len(self.words))
        best = np.full(len(self.words), len(other.words), dtype=np.int64)
        np.minimum.at(best, mine, theirs)
        for i in np.flatnonzero(near).tolist():
            yield self.words[i], int(near[i]), other.n[best[i]], other.words[best[i]]


def _near_in(length: int, at_end: bool, same: bool, left: list[dict], right: list[dict]) -> Iterator[tuple]:
    """Near pairs of two blocks of one key: words of ``length`` with each other and with words one letter longer."""
    half = length // 2
    short, long = [[_Side(held, n) for held in (left, right)] for n in (length, length + 1)]
    pairs = [(short[0], short[1])] + ([(short[0], long[0])] if same else [(short[0], long[1]), (short[1], long[0])])
    for a, b in pairs:
        if not a.words or not b.words:
            continue
        i, j = tile(a.letters, b.letters)
        fresh = np.ones(len(i), dtype=bool)
        if at_end and half:  # pairs that also share the first half are found there
            fresh &= (a.letters[i, :half] != b.letters[j, :half]).any(axis=1)
        if a.letters.shape == b.letters.shape and same and a is short[0] and b is short[1]:
            fresh &= i != j
            yield from a.rows(i[fresh], j[fresh], b)  # the tile holds both orders of each pair
            continue
        i, j = i[fresh], j[fresh]
        yield from a.rows(i, j, b)
        yield from b.rows(j, i, a)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, kinds = ("word", "near", "form_n", "form"), (pa.string(), pa.int64(), pa.int64(), pa.string())
    for batch in sliced(batches, 64):
        found = []
        for row in batch.to_pylist():
            same = row["first"] == row["second"]
            found += _near_in(row["length"], row["at_end"], same, row["left"], row["left"] if same else row["right"])
        columns = list(zip(*found)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def near_words(words: DataFrame, block_words: int = BLOCK_WORDS, block_letters: int = BLOCK_LETTERS) -> DataFrame:
    """``word``, ``n_near`` and its near word of largest count (ties: the smallest), ``near_n`` and ``near_word``.

    ``words`` has distinct ``word`` and its ``n``. A word without a near word has no row.
    """
    size, key = F.length("word"), ["length", "at_end", "part"]
    halves = []
    for length in (size, size - 1):  # a word is the shorter one of a pair, or one letter longer than the other
        half = F.floor(length / 2).cast("int")
        halves += [
            F.struct(length.alias("length"), F.lit(False).alias("at_end"), F.substring("word", F.lit(1), half).alias("part")),
            F.struct(length.alias("length"), F.lit(True).alias("at_end"), F.right("word", length - half).alias("part")),
        ]
    keyed = words.select("word", "n", F.explode(F.array(*halves)).alias("key")).select("key.*", "word", "n").where("length > 0")
    sizes = keyed.groupBy(*key).agg(F.count(F.lit(1)).alias("words"), F.count_if(size == F.col("length")).alias("shorter"))
    in_block = F.greatest(F.least(F.lit(block_words), F.floor(F.lit(block_letters) / (F.col("length") + 1))), F.lit(1))
    sizes = sizes.where("words > 1 and shorter > 0").select(*key, F.ceil(F.col("words") / in_block).cast("int").alias("blocks"))
    blocked = keyed.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    blocks = blocked.groupBy(*key, "blocks", "block").agg(F.collect_list(F.struct("word", "n")).alias("held"))
    # Each block goes to its pairs with all blocks of its key; of a block with itself there is one row.
    sided = blocks.select(*key, "block", "held", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    sided = sided.select(*key, F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "block", "held")
    of = lambda place: F.first(F.when(F.col("block") == F.col(place), F.col("held")), ignorenulls=True)
    tiles = sided.groupBy(*key, "first", "second").agg(of("first").alias("left"), of("second").alias("right"))
    empty = F.array().cast(tiles.schema["left"].dataType)  # a block to which no word was dealt
    tiles = tiles.withColumns({side: F.coalesce(side, empty) for side in ("left", "right")})
    partial = tiles.mapInArrow(_compared, "word string, near long, form_n long, form string")
    best = F.min(F.struct((-F.col("form_n")).alias("minus"), F.col("form").alias("word"))).alias("best")
    total = partial.groupBy("word").agg(F.sum("near").alias("n_near"), best)
    return total.select("word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.word").alias("near_word"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word`` and ``root``, the last form that is reached; each round doubles the steps taken.

    A form is at least twice as frequent as its word, so no chain has over 62 steps or comes back.
    """
    reached = saved(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while reached.where("moved").limit(1).count():
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        reached = reached.join(further, "root", "left")
        reached = saved(reached.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return reached.select("word", "root")


def spelling_variants(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    damage_every: int | None = None,
    least_letters: int = 5,
    least_count: int = 3,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Every frequent word with its likely spelling: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    Words are the runs of A-Z, a-z and U+00C0 to U+00FF in whole texts, A-Z
    lower-cased, of ``least_letters`` and ``least_count`` or more. ``form`` is the
    near word (one letter inserted, deleted or replaced) of largest count, ties by
    code points, if it is at least twice as frequent; ``root`` is the last form
    that is reached, or the word itself. ``damage_every`` plants typing errors: a
    run loses one letter where the CRC-32 of ``id:run`` is divisible by it.

    Defined cases: null and empty texts have no words; a null id counts as an
    empty one; repeated rows count each time; a text or a run of any length is
    read whole; an empty table gives no row. Other columns are ignored.
    """
    words = saved(word_counts(documents, id_column, text_column, damage_every, least_letters, least_count), "words")
    found = words.join(near_words(words, block_words), "word", "left")
    is_form = F.col("near_n") >= 2 * F.col("n")
    found = found.select(
        "word", F.when(is_form, F.col("near_word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("near_n")).alias("form_n")
    )
    found = saved(found, "forms")
    roots = _roots(found.where("form is not null"))
    found = found.join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
