"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Two models, one of toxic and one of ordinary words, predict each byte of a word
from the bytes before it. Both are discounted Kneser-Ney models of one order
and fall back to the same lower-order model, whose continuation counts are
taken from both classes; so a rare expression is judged by what its known
stems say, and by nothing where neither class knows it. The difference of the
two log-likelihoods is a sum over words. A text is judged by the differences of
its distinct words, as mean and strongest one, and as sums and numbers of strong
ones over the length or its square root (chance alone makes sums of evidence grow
like that), so a long text is not judged by its length. A logistic curve puts
them on one scale. It is fitted to all labelled texts of the sample, each as seen
by models of the other folds; each row stands there for as many labelled rows of
its class as the sample left out, so a score means the same at every size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, StructField, StructType

from tidyloom.llm.store import bounded_batches, saved
from tidyloom.llm.words import give_back, giving_back, sliced

ORDER = 6  # bytes, the predicted one included: a key fits into 64 bits
DISCOUNT = 0.75
#: Labelled rows the classifier is fitted on at most, half of them toxic, and distinct words of each, drawn by a hash where it has more.
MAX_LABELLED, MAX_LABELLED_WORDS = 12_000, 4_000
#: Evidence (natural log of the likelihood ratio) from which a word counts as strong.
STRONG = 3.0
FOLDS = 5
_FEATURES = 6
_CACHE = 150_000
_WORDS_AT_ONCE = 20_000

# Words are runs of letters, A-Z lower-cased; any byte of a longer character counts as a letter.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def distinct_words(blob: bytes | None) -> list[bytes]:
    return sorted(set((blob or b"").translate(_LETTERS).split()))


def _padded(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all n-grams of the words: up to ORDER bytes in an integer, and the word each belongs to.

    A word is read behind ORDER - 1 bytes 1 and is closed by a byte 2.
    """
    lead = b"\x01" * (ORDER - 1)
    data = np.frombuffer(b"".join(lead + w + b"\x02" for w in words), dtype=np.uint8)
    lengths = np.fromiter((len(w) + ORDER for w in words), dtype=np.int64, count=len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    keys = np.zeros(len(data), dtype=np.int64)
    for back in range(ORDER):
        keys[ORDER - 1 :] |= data[ORDER - 1 - back : len(data) - back].astype(np.int64) << (8 * back)
    place = np.arange(len(data)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    full = place >= ORDER - 1
    return keys[full], owner[full]


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(keys, return_inverse=True)
    return unique, np.bincount(back, weights=weights, minlength=len(unique))


def _counted(words: list[bytes], weights: tuple[np.ndarray, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """All distinct n-grams of the words in order, and the sums of each kind of weights; only so many words are spelled out at once."""
    grams, sums = np.empty(0, np.int64), [np.zeros(0) for _ in weights]
    found: list[tuple] = []
    for lo in range(0, len(words), _WORDS_AT_ONCE):
        keys, owner = _padded(words[lo : lo + _WORDS_AT_ONCE])
        unique, back = np.unique(keys, return_inverse=True)
        found.append((unique, [np.bincount(back, weights=w[lo + owner], minlength=len(unique)) for w in weights]))
        # Merged when what waits is as long as what is there, so that every n-gram is merged a few times only.
        if sum(len(u) for u, _ in found) > len(grams) or lo + _WORDS_AT_ONCE >= len(words):
            parts = [(grams, sums), *found]
            del grams, sums
            grams, back = np.unique(np.concatenate([u for u, _ in parts]), return_inverse=True)
            sums = [np.bincount(back, weights=np.concatenate([s[i] for _, s in parts]), minlength=len(grams)) for i in range(len(weights))]
            found = []
    return grams, sums


def _at(table: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Value of each key, 0 for unknown keys."""
    if not len(table):
        return np.zeros(len(keys))
    slot = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return np.where(table[slot] == keys, values[slot], 0.0)


class Evidence:
    """Log-likelihood ratio of each known n-gram, and of falling back from each known context."""

    def __init__(self, words: list[bytes], toxic: np.ndarray, ordinary: np.ndarray):
        grams, counts = _counted(words, (toxic, ordinary))
        shared = self._shared(grams)
        contexts, of = np.unique(grams >> 8, return_inverse=True)
        logs, falls = [], []
        for c in counts:
            total = np.bincount(of, weights=c, minlength=len(contexts))
            kinds = np.bincount(of, weights=c > 0, minlength=len(contexts))
            fall = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1.0)
            logs.append(np.log(np.maximum(c - DISCOUNT, 0) / np.maximum(total[of], 1) + fall[of] * shared))
            falls.append(np.log(fall))
        self.grams, self.gram_ratio = grams, logs[0] - logs[1]
        self.contexts, self.fall_ratio = contexts, falls[0] - falls[1]

    def arrays(self) -> tuple[np.ndarray, ...]:
        return self.grams, self.gram_ratio, self.contexts, self.fall_ratio

    @classmethod
    def of_arrays(cls, arrays: tuple[np.ndarray, ...]) -> Evidence:
        made = cls.__new__(cls)
        made.grams, made.gram_ratio, made.contexts, made.fall_ratio = arrays
        return made

    @staticmethod
    def _shared(grams: np.ndarray) -> np.ndarray:
        """Kneser-Ney probability of the last byte after the shorter context, from continuation counts of both classes."""
        known, below = grams[:0], np.zeros(0)
        for order in range(1, ORDER):
            longer = np.unique(grams & ((1 << (8 * (order + 1))) - 1))
            keys, counts = _summed(longer & ((1 << (8 * order)) - 1), np.ones(len(longer)))
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            total = np.bincount(of, weights=counts)
            kinds = np.bincount(of)
            lower = 1 / 256 if order == 1 else _at(known, below, keys & ((1 << (8 * (order - 1))) - 1))
            p = np.maximum(counts - DISCOUNT, 0) / total[of] + DISCOUNT * kinds[of] / total[of] * lower
            known, below = keys, p
        return _at(known, below, grams & ((1 << (8 * (ORDER - 1))) - 1))

    def of(self, words: list[bytes]) -> np.ndarray:
        """The ratio of each word: above 0 speaks for the toxic class."""
        if not words or not len(self.grams):
            return np.zeros(len(words))
        keys, owner = _padded(words)
        slot = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        seen = self.grams[slot] == keys
        ratio = np.where(seen, self.gram_ratio[slot], 0.0)
        unseen = ~seen
        ratio[unseen] = _at(self.contexts, self.fall_ratio, keys[unseen] >> 8)
        return np.bincount(owner, weights=ratio, minlength=len(words))


def _features(model: Broadcast):
    """Features of texts by the model whose arrays are broadcast.

    A large object that a function brings with it is held twice in a process, as read and as made of that; arrays of a broadcast once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence.of_arrays(model.value)
        known: dict[bytes, float] = {}
        for batch in sliced(batches):
            rows = []
            for blob in batch.column("text").to_pylist():
                words = distinct_words(blob)
                new = [w for w in words if w not in known]
                for lo in range(0, len(new), 20_000):
                    part = new[lo : lo + 20_000]
                    known.update(zip(part, evidence.of(part).tolist()))
                rows.append(_described(np.array([known[w] for w in words])))
                if len(known) > _CACHE:
                    known.clear()
            kept = [name for name in batch.schema.names if name != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), pa.array(rows, pa.list_(pa.float64()))], names=[*kept, "x"])

    return run


def _described(ratios: np.ndarray) -> list[float]:
    if not len(ratios):
        return [0.0] * _FEATURES
    strong, root = ratios[ratios >= STRONG], np.sqrt(len(ratios))
    return [
        float(ratios.mean()),
        float(max(ratios.max(), 0.0)),
        float(len(strong) / len(ratios)),
        float(np.log1p(len(strong) / root)),
        float(np.log1p(strong.sum() / root)),
        float(np.log1p(np.maximum(ratios, 0).sum() / root)),
    ]


class Curve:
    """Logistic curve over standardised features, by Newton steps with a small ridge; ``stands`` is how many rows each stands for."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, stands: np.ndarray | None = None):
        self.mean, self.scale, self.weights = np.zeros(_FEATURES), np.ones(_FEATURES), np.zeros(_FEATURES + 1)
        if not len(y):
            return
        # Of mean 1, so that the ridge weighs the same against few and many left out.
        share = np.ones(len(y)) if stands is None else stands / stands.mean()
        self.mean = np.average(x, axis=0, weights=share)
        self.scale = np.sqrt(np.average((x - self.mean) ** 2, axis=0, weights=share)) + 1e-9
        z = np.column_stack([np.ones(len(y)), (x - self.mean) / self.scale])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ self.weights, -35, 35)))
            pull = z.T @ (share * (y - p)) - ridge * self.weights
            step = np.linalg.solve(z.T @ (z * (share * p * (1 - p))[:, None]) + ridge * np.eye(_FEATURES + 1), pull)
            self.weights = self.weights + step
            if np.abs(step).max() < 1e-8:
                break

    def column(self, features: str) -> Column:
        """The score of a row with an array of features."""
        total = F.lit(float(self.weights[0]))
        for i in range(_FEATURES):
            total = total + (F.col(features)[i] - float(self.mean[i])) / float(self.scale[i]) * float(self.weights[i + 1])
        return 1 / (1 + F.exp(-F.greatest(F.lit(-35.0), F.least(F.lit(35.0), total))))


def fitted(
    documents: DataFrame, labels: DataFrame, train: Column, id_column: str, text_column: str, label_column: str, max_labelled: int, max_words: int
) -> tuple[Evidence, Curve]:
    """Models of at most ``max_labelled`` labelled rows, and the curve over them, each row seen by models of other folds."""
    marks = labels.where(train & F.col(label_column).isin(0, 1)).groupBy(F.col(id_column).alias("id")).agg(F.max(F.col(label_column).cast("int")).alias("y"))
    # The labelled rows there are: ids alone, so that what is ordered and broadcast is small.
    present = documents.where(train).groupBy(F.col(id_column).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    present = saved(present.join(marks, "id"), "marks")
    order = F.xxhash64(F.col("id").cast("string"), F.lit("fit"))
    halves = [present.where(F.col("y") == y).orderBy(order, "id").limit(max_labelled // 2) for y in (0, 1)]
    wanted = saved(halves[0].unionByName(halves[1]).select("id", "y"), "wanted")
    texts = documents.where(train).select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text")).join(F.broadcast(wanted), "id")
    drawn = texts.mapInArrow(giving_back(_drawn(max_words)), StructType([texts.schema["id"], StructField("y", IntegerType()), StructField("words", ArrayType(BinaryType()))]))
    fold = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("fold")), F.lit(FOLDS)).cast("int")
    # Of repeated rows of one id one is taken.
    sample = saved(drawn.groupBy("id", "y").agg(F.min("words").alias("words")).withColumn("fold", fold), "sample")
    every, drawn_rows = (dict(map(tuple, f.collect())) for f in (present.groupBy("y").agg(F.sum("n")), sample.groupBy("y").count()))

    toxic = F.sum("y").alias("toxic"), (F.count(F.lit(1)) - F.sum("y")).alias("ordinary")
    # A text counts a word once, so that long texts do not outweigh others.
    words = sample.select("y", "fold", F.explode("words").alias("word"))
    # What the models of a fold learn from: the words of all other folds.
    others = words.withColumn("of", F.explode(F.array(*[F.lit(k) for k in range(FOLDS)]))).where(F.col("of") != F.col("fold"))
    learned = others.groupBy("of", "word").agg(*toxic).withColumnRenamed("of", "fold")
    seen = learned.groupBy("fold").cogroup(sample.select("fold", "y", "words").groupBy("fold")).applyInArrow(_seen_by_others, "y int, x array<double>").toArrow()
    counts = words.groupBy("word").agg(*toxic).toArrow()
    # The sample is of bounded rows and words, and so is what comes to the driver.
    evidence = _evidence(counts)
    x = np.array(seen.column("x").to_pylist(), dtype=float).reshape(-1, _FEATURES)
    y = seen.column("y").to_numpy().astype(float)
    return evidence, Curve(x, y, stands=np.array([every[int(label)] / drawn_rows[int(label)] for label in y]))


def _evidence(counts: pa.Table) -> Evidence:
    toxic, ordinary = (counts.column(name).to_numpy().astype(float) for name in ("toxic", "ordinary"))
    return Evidence(counts.column("word").to_pylist(), toxic, ordinary)


def _drawn(max_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 64):
            found = [distinct_words(blob) for blob in batch.column("text").to_pylist()]
            # Words of a long text are drawn over the whole of it.
            found = [sorted(words, key=zlib.crc32)[:max_words] if len(words) > max_words else words for words in found]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(found, pa.list_(pa.binary()))], names=["id", "y", "words"])

    return run


def _seen_by_others(learned: pa.Table, rows: pa.Table) -> pa.Table:
    """Features of a fold's rows by models of the other folds."""
    evidence, found = _evidence(learned), []
    for batch in sliced(iter(rows.to_batches()), 32):
        lists = batch.column("words").to_pylist()
        ratio = evidence.of([word for words in lists for word in words])
        ends = np.cumsum([len(words) for words in lists])
        found += [_described(part) for part in np.split(ratio, ends[:-1])]
    del evidence
    give_back()
    return pa.table([rows.column("y"), pa.array(found, pa.list_(pa.float64()))], names=["y", "x"])


def toxicity(
    documents: DataFrame,
    labels: DataFrame,
    train: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    max_labelled: int = MAX_LABELLED,
    carry: str | None = None,
    max_words: int = MAX_LABELLED_WORDS,
) -> DataFrame:
    """The id, ``score`` (0 to 1, higher: more likely toxic) and the column ``carry`` for every row of ``documents``.

    ``train`` is a condition on the id column: labels of other rows are never
    read. The classifier is fitted on at most ``max_labelled`` labelled rows,
    half of each class, by at most ``max_words`` distinct words of each (drawn by a
    hash over the whole text); in the curve both classes weigh as they do among
    all labelled training rows. Every whole text is scored, of any length.

    Defined cases: null, empty and blank texts have no evidence and get the score of
    that; without usable labels, or with one class only, every score is the same for
    one text; labels other than 0 and 1 are ignored and of several labels of a row
    the highest counts; repeated rows are each scored, and for the fit one of them is
    taken. Other columns are ignored.
    """
    bounded_batches(documents.sparkSession)
    evidence, curve = fitted(documents, labels, train, id_column, text_column, label_column, max_labelled, max_words)
    model = documents.sparkSession.sparkContext.broadcast(evidence.arrays())
    carried = [F.col(carry).alias("carried")] if carry else []
    source = documents.select(F.col(id_column).alias("id"), *carried, F.col(text_column).cast("binary").alias("text"))
    found = source.mapInArrow(giving_back(_features(model)), StructType([*source.schema.fields[:-1], StructField("x", ArrayType(DoubleType()))]))
    return found.select(F.col("id").alias(id_column), *(F.col("carried").alias(carry) for _ in carried), curve.column("x").alias("score"))
