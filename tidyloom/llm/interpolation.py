"""Language-model scores by deleted interpolation of bigram, word and uniform estimates.

The probability of a word after another mixes maximum-likelihood estimates; the
weights depend on how often the context was seen (buckets of doubling counts)
and are learned by expectation-maximisation on counts with the scored
occurrence deleted.

Counts of the whole corpus meet its texts block by block. A block of documents
sends the hashes of its distinct words and bigrams, with their counts in
training documents, sorted and cut into parts; each part adds up what all blocks
have sent and answers every block with the totals in the order of its question.
So an answer needs no keys, a frequent word is one entry for each block, and
no table of n-grams is ever sent to all tasks. Questions and answers are one
plan, in which both read the same exchange of the texts. With its answers each
text is written once as the counts of its tokens; weights and scores are read
from those without a further shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidyloom.llm.words import BLANK_SEPARATED, Words, chunks, mix, sliced
from tidyloom.settings import stored

#: Text bytes of a block, about; larger blocks send fewer hashes and need more memory.
BLOCK_BYTES = 8 << 20
_END, _BEGIN = np.uint64(0x1B873593CC9E2D51), np.uint64(0x85EBCA6BC2B2AE35)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_BUCKETS = 48
_GRID = 4  # steps of the logarithm to base 2 in which estimates are counted for the weights
WORD, PAIR = 0, 1


def _tokens(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and ends, of bigrams, and where each text's tokens begin (one more at the end)."""
    tokens, pairs, begins = [], [], [np.zeros(1, dtype=np.int64)]
    for lo, hi in chunks(blobs):
        words = Words(blobs[lo:hi], BLANK_SEPARATED)
        ends = words.ranges[1:]
        part = np.insert(words.hashes(), ends, _END)
        stops = ends + np.arange(1, hi - lo + 1)
        context = np.concatenate(([_BEGIN], part[:-1]))
        context[stops[:-1]] = _BEGIN
        tokens.append(part)
        pairs.append(mix(context * _PAIR + part))
        begins.append(stops + begins[-1][-1])
    if not tokens:
        return np.empty(0, np.uint64), np.empty(0, np.uint64), begins[0]
    return np.concatenate(tokens), np.concatenate(pairs), np.concatenate(begins)


def _planes(values: np.ndarray, kind: str) -> bytes:
    """The numbers byte by byte, all first bytes, all second bytes and so on: sorted or small numbers compress well."""
    return values.astype(kind).view(np.uint8).reshape(len(values), np.dtype(kind).itemsize).T.tobytes()


def _from_planes(raw: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(width, -1).T).view(kind).ravel()


def _packed(raw: bytes) -> bytes:
    """Counts are small and alike; Zstandard takes less room than Spark's own shuffle compression."""
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(raw: bytes) -> bytes:
    return pa.decompress(raw[8:], decompressed_size=int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)


def _distinct(hashes: np.ndarray, train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All distinct hashes in order, with counts of those in training texts."""
    seen, counts = np.unique(hashes[train], return_counts=True)
    keys = np.union1d(seen, hashes[~train])
    out = np.zeros(len(keys), dtype=np.int64)
    out[np.searchsorted(keys, seen)] = counts
    return keys, out


def _questions(parts: int):
    def run(key: tuple, docs: pa.Table) -> pa.Table:
        block = key[0].as_py()
        tokens, pairs, begins = _tokens([b or b"" for b in docs.column("text").to_pylist()])
        train = np.repeat(docs.column("train").to_numpy(), np.diff(begins))
        rows = []
        for kind, hashes in ((WORD, tokens), (PAIR, pairs)):
            keys, counts = _distinct(hashes, train)
            part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)  # in the order of the hashes
            cuts = np.flatnonzero(np.diff(part)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)]):
                if hi > lo:
                    rows.append((block, kind, int(part[lo]), _planes(keys[lo:hi], "<u8"), _packed(_planes(counts[lo:hi], "<u4"))))
        return _table(rows, ("block", "kind", "part", "keys", "counts"), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()))

    return run


def _table(rows: list[tuple], names: tuple, kinds: tuple) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=list(names))


def _answers(key: tuple, sent: pa.Table) -> pa.Table:
    """Totals of one part for every block that asked; and, as block -1, the part's tokens and types."""
    kind, part = key[0].as_py(), key[1].as_py()
    blocks = sent.column("block").to_pylist()
    keys = [_from_planes(b, "<u8") for b in sent.column("keys").to_pylist()]
    counts = [_from_planes(_unpacked(b), "<u4") for b in sent.column("counts").to_pylist()]
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    first = np.concatenate(([True], np.diff(every[order]) != 0))
    total = np.add.reduceat(np.concatenate(counts).astype(np.int64)[order], np.flatnonzero(first))
    back = np.empty(len(every), dtype=np.int64)
    back[order] = np.cumsum(first) - 1
    rows, at = [(-1, kind, part, b"", int(total.sum()), int((total > 0).sum()))], 0
    for block, own in zip(blocks, keys):
        rows.append((block, kind, part, _packed(_planes(total[back[at : at + len(own)]], "<u8")), 0, 0))
        at += len(own)
    return _table(rows, ("block", "kind", "part", "totals", "tokens", "types"), (pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))


def _narrow(counts: np.ndarray) -> bytes:
    """The numbers byte by byte, in as few bytes each as the largest needs: 1, 2, 4 or 8."""
    return _packed(_planes(counts, f"<u{next(w for w in (1, 2, 4, 8) if w == 8 or int(counts.max()) >> 8 * w == 0)}"))


def _matched(hashes: np.ndarray, answered: list[bytes]) -> np.ndarray:
    keys, back = np.unique(hashes, return_inverse=True)
    totals = np.concatenate([_from_planes(_unpacked(raw), "<u8") for raw in answered]) if answered else np.empty(0, np.uint64)
    if len(totals) != len(keys):
        raise RuntimeError(f"{len(totals)} answers to {len(keys)} questions: a block was not the same when it was read again")
    return totals.astype(np.int64)[back]


def _counted(id_type: pa.DataType):
    """Each text of a block as the counts of its tokens in the whole training corpus; every text has its end at least.

    Block -1, which has no texts, is one row with the corpus's tokens and types of words; they are null on a text's row.
    """

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        if not docs.num_rows:
            words = answers.filter(pc.equal(answers.column("kind"), WORD))
            row = ([None], [False], [0], [b""], [b""], *([pc.sum(words.column(name)).as_py()] for name in ("tokens", "types")))
            kinds = (id_type, pa.bool_(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())
            return pa.table([pa.array(value, kind) for value, kind in zip(row, kinds)], names=["id", "train", "n_tokens", "words", "pairs", "tokens", "types"])
        tokens, pairs, begins = _tokens([b or b"" for b in docs.column("text").to_pylist()])
        found = sorted(zip(answers.column("kind").to_pylist(), answers.column("part").to_pylist(), answers.column("totals").to_pylist()))
        word, pair = (_matched(hashes, [raw for k, _, raw in found if k == kind]) for kind, hashes in ((WORD, tokens), (PAIR, pairs)))
        texts = list(zip(begins[:-1].tolist(), begins[1:].tolist()))
        return pa.table(
            {
                "id": docs.column("id").combine_chunks(),
                "train": docs.column("train").combine_chunks(),
                "n_tokens": pa.array(np.diff(begins), pa.int64()),
                "words": pa.array([_narrow(word[lo:hi]) for lo, hi in texts], pa.binary()),
                "pairs": pa.array([_narrow(pair[lo:hi]) for lo, hi in texts], pa.binary()),
                "tokens": pa.nulls(len(texts), pa.int64()),
                "types": pa.nulls(len(texts), pa.int64()),
            }
        )

    return run


class _Counted:
    """Counts of the words, bigrams and contexts of texts, and where each text's tokens begin (one more at the end)."""

    def __init__(self, texts: pa.RecordBatch):
        sizes = texts.column("n_tokens").to_numpy()
        self.begins = np.concatenate(([0], np.cumsum(sizes)))
        self.word, self.pair = (
            np.concatenate([_from_planes(raw, f"<u{len(raw) // n}").astype(np.int64) for raw, n in zip(map(_unpacked, texts.column(name).to_pylist()), sizes.tolist())])
            for name in ("words", "pairs")
        )
        # A context is counted as a word; the begin of a text as the end of one.
        self.context = np.concatenate(([0], self.word[:-1]))
        self.context[self.begins[:-1]] = self.word[self.begins[1:] - 1]


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the floor of its logarithm to base 2."""
    return np.minimum(np.frexp(context.astype(np.float64))[1], _BUCKETS - 1)


def _observed(total: int):
    """How often each bucket met each pair of estimates in training texts, on a logarithmic grid, the scored occurrence deleted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            c = _Counted(batch)
            context, pair, word = c.context - 1, c.pair - 1, c.word - 1
            grid = []
            for estimate in (pair / np.maximum(context, 1), word / max(total - 1, 1)):
                steps = np.rint(_GRID * np.log2(np.where(estimate > 0, estimate, 1)))
                grid.append(np.where(estimate > 0, np.minimum(-steps, 999), 1000).astype(np.int64))
            new, n = np.unique((_bucket(context).astype(np.int64) * 1001 + grid[0]) * 1001 + grid[1], return_counts=True)
            keys, back = np.unique(np.concatenate((keys, new)), return_inverse=True)
            sums = np.zeros(len(keys), dtype=np.int64)
            np.add.at(sums, back, np.concatenate((counts, n)))
            counts = sums
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts, pa.int64())], names=["key", "n"])

    return run


def mixture_weights(keys: np.ndarray, counts: np.ndarray, types: int, rounds: int = 60) -> np.ndarray:
    """Weights of bigram, word and uniform estimates for each bucket, by expectation-maximisation."""
    bucket, rest = np.divmod(keys, 1001 * 1001)
    first, second = np.divmod(rest, 1001)
    estimates = np.stack([np.where(q >= 1000, 0.0, 2.0 ** (-q / _GRID)) for q in (first, second)] + [np.full(len(keys), 1 / (types + 1))])
    weights = np.full((_BUCKETS, 3), 1 / 3)
    for _ in range(rounds):
        share = weights[bucket].T * estimates
        share *= counts / np.maximum(share.sum(axis=0), 1e-300)
        gained = np.stack([np.bincount(bucket, weights=s, minlength=_BUCKETS) for s in share], axis=1)
        weights = (gained + 1) / (gained.sum(axis=1, keepdims=True) + 3)  # one assumed token for each part
    weights[0, 0] = 0  # an unseen context tells nothing
    return weights / weights.sum(axis=1, keepdims=True)


def _scores(total: int, types: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            if not batch.num_rows:
                continue
            c = _Counted(batch)
            mixed = weights[_bucket(c.context)]
            p = mixed[:, 0] * (c.pair / np.maximum(c.context, 1)) + mixed[:, 1] * (c.word / max(total, 1)) + mixed[:, 2] / (types + 1)
            base = np.log10((c.word + 1) / (total + types + 1))
            known, base, score = (np.add.reduceat(x, c.begins[:-1]) for x in ((c.word > 0).astype(np.int64), base, np.log10(p)))
            columns = [batch.column("id"), batch.column("n_tokens"), pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "n_known", "base_score", "score"])

    return run


def interpolated_scores(
    documents: DataFrame, train: Column, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The id, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` for every row.

    ``train`` marks the rows that are learned from. Counts are taken from all of
    them. So are the weights, with each scored occurrence deleted from its counts;
    no score depends on how texts are dealt over blocks.
    Tokens are words between white space, A-Z in lower case, and one end for
    each text. ``base_score`` sums log10((c + 1) / (N + V + 1)), ``score`` the
    mixture's log10 probabilities.

    Defined cases: null and empty texts are their end alone; repeated rows count
    and are scored each; a null id or a null condition means not learned from;
    without training rows N and V are 0 and every token has the same probability;
    an empty table gives no row. Other columns are ignored. Keys are 64-bit
    hashes: of n different n-grams, about n**2 / 2**65 pairs are taken for one.
    """
    size = F.coalesce(F.octet_length(F.col(text_column)), F.lit(0)) + 1
    total_bytes = documents.agg(F.sum(size.cast("long"))).first()[0] or 0
    blocks = max(1, ceil(total_bytes / block_bytes))
    kind = documents.select(id_column).schema[0].dataType
    docs = documents.select(
        F.pmod(F.xxhash64(F.col(id_column), F.col(text_column)), F.lit(blocks)).alias("block"),
        F.col(id_column).alias("id"),
        F.col(text_column).cast("binary").alias("text"),
        F.coalesce(train, F.lit(False)).alias("train"),
    )
    # Both groupings take the same columns, so that Spark deals the texts out once for the two.
    sent = docs.groupBy("block").applyInArrow(_questions(blocks), "block long, kind int, part long, keys binary, counts binary")
    answers = sent.groupBy("kind", "part").applyInArrow(_answers, "block long, kind int, part long, totals binary, tokens long, types long")
    name = kind.simpleString()
    columns = f"id {name}, train boolean, n_tokens long, words binary, pairs binary, tokens long, types long"
    # A checkpoint, since Spark removes it when the scores are no longer used.
    counted = stored(docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_counted(to_arrow_type(kind)), columns))
    tokens, types = counted.where("tokens is not null").agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.sum("types"), F.lit(0))).first()
    counted = counted.where("tokens is null")
    seen = counted.where("train").select("n_tokens", "words", "pairs").mapInArrow(_observed(tokens), "key long, n long")
    seen = seen.groupBy("key").agg(F.sum("n").alias("n")).toArrow().sort_by("key")  # a bounded grid; one order, so that sums of doubles are the same each time
    weights = mixture_weights(seen.column("key").to_numpy(), seen.column("n").to_numpy().astype(float), types)
    found = counted.select("id", "n_tokens", "words", "pairs")
    found = found.mapInArrow(_scores(tokens, types, weights), f"id {name}, n_tokens long, n_known long, base_score double, score double")
    return found.select(F.col("id").alias(id_column), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
