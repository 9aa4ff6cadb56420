"""Near duplicates by circulant MinHash: two permutations give all coordinates of a signature.

One permutation spreads the shingles over a circle of places. The other gives
every place a rank; shifted by 1, 2, 3, ... places it serves as the next hash
function. Signatures are cut into bands; texts that share a band are compared
on their full shingle sets, so no link is wrong. A pair at the threshold itself
is missed with a chance of (1 - t**rows)**bands, 3e-6 by default.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidyloom.llm.store import bounded_batches, bounded_broadcast, connected, saved
from tidyloom.llm.words import BLANK_SEPARATED, Words, chunks, giving_back, mix, shingles, sliced

_PLACES = 1 << 20
BANDS, ROWS = 24, 4
#: Candidate ids (8 bytes each) that are broadcast at most; more are joined by shuffle.
BROADCAST_IDS = 2_000_000


class Circulant:
    """Signatures of one band layout: coordinate k of a set is the least rank, shifted by k places."""

    def __init__(self, bands: int, rows: int, seed: int = 20):
        order = np.random.Generator(np.random.PCG64(seed)).permutation(_PLACES).astype(np.uint32)
        self.ranks = np.concatenate([order[-bands * rows :], order])  # a shift never needs a wrap
        self.bands, self.rows, self.shift = bands, rows, bands * rows

    def bands_of(self, hashes: np.ndarray) -> list[int]:
        places = (mix(hashes ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(_PLACES - 1)).astype(np.int64) + self.shift
        least = np.fromiter((self.ranks[places - k].min() for k in range(self.shift)), dtype=np.uint64, count=self.shift)
        folded = np.arange(1, self.bands + 1, dtype=np.uint64)
        for column in least.reshape(self.bands, self.rows).T:
            folded = mix(folded * np.uint64(0xD6E8FEB86659FD93) + column)
        return folded.view(np.int64).tolist()


def _signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circle = Circulant(bands, rows)
        for batch in sliced(batches):
            blobs = [b or b"" for b in batch.column(1).to_pylist()]
            counts, digests, found = [], [], []
            for lo, hi in chunks(blobs):
                words = Words(blobs[lo:hi], BLANK_SEPARATED)
                hashes = words.hashes()
                for i in range(hi - lo):
                    unique = np.unique(shingles(hashes[words.ranges[i] : words.ranges[i + 1]], size))
                    counts.append(len(unique))
                    digests.append(hashlib.md5(unique.tobytes()).digest() if len(unique) else None)
                    found.append(circle.bands_of(unique) if len(unique) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(found, pa.list_(pa.int64()))],
                names=["id", "n", "digest", "bands"],
            )

    return run


def _grams(size: int):
    """The distinct shingles of each text, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            blobs = [b or b"" for b in batch.column(1).to_pylist()]
            for lo, hi in chunks(blobs):
                words = Words(blobs[lo:hi], BLANK_SEPARATED)
                hashes = words.hashes()
                found = [np.unique(shingles(hashes[words.ranges[i] : words.ranges[i + 1]], size)) for i in range(hi - lo)]
                owner = np.repeat(np.arange(lo, hi), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(np.concatenate(found).view(np.int64))], names=["node", "gram"])

    return run


def _confirmed(size: int, per_cent: int):
    def grams(blob: bytes) -> set:
        words = blob.translate(BLANK_SEPARATED).split()
        return set(zip(*(words[i:] for i in range(min(size, len(words))))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            known: dict = {}
            kept = []
            a, b, left, right = (batch.column(i).to_pylist() for i in range(4))
            for i in range(batch.num_rows):
                if a[i] not in known:  # rows of a hub lie together: its set is made once
                    known = {a[i]: grams(left[i])}
                x, y = known[a[i]], grams(right[i])
                both = len(x & y)
                kept.append(100 * both >= per_cent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return run


def _hubs(members: DataFrame, bucket: str, count: int) -> DataFrame:
    """The first ``count`` members of each bucket."""
    number = F.row_number().over(Window.partitionBy(bucket).orderBy(F.col("n") - F.col("most"), "node"))
    hubs = members.withColumn("number", number).where(F.col("number") <= count)
    return saved(hubs.select(bucket, *(F.col(c).alias(f"hub_{c}") for c in ("node", "n", "most", "group"))), "hubs")


def _pairs(members: DataFrame, hubs: DataFrame, bucket: str, per_cent: int) -> DataFrame:
    """Hubs and members of other components that have room for a link: ``most`` shingles of either can be shared."""
    both = F.least("most", "hub_most")
    room = 100 * both >= per_cent * (F.col("n") + F.col("hub_n") - both)
    pairs = members.join(hubs, bucket).where((F.col("group") != F.col("hub_group")) & room)
    return saved(pairs.select(F.least("hub_node", "node").alias("a"), F.greatest("hub_node", "node").alias("b")).distinct(), "pairs")


def _linked(pairs: DataFrame, texts: DataFrame, kind: str, size: int, per_cent: int) -> DataFrame:
    sides = pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("left")), "a")
    sides = sides.join(texts.select(F.col("id").alias("b"), F.col("text").alias("right")), "b").select("a", "b", "left", "right")
    return sides.mapInArrow(giving_back(_confirmed(size, per_cent)), f"a {kind}, b {kind}")


def _regrouped(members: DataFrame, groups: DataFrame) -> DataFrame:
    return members.drop("group").join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _mixed(members: DataFrame, bucket: str, per_cent: int) -> DataFrame:
    """Members of buckets with several components, without those that have no room for a link with any other."""
    mixed = members.groupBy(bucket).agg(F.min("group").alias("low"), F.max("group").alias("high"), F.min("n").alias("least_n")).where("low < high")
    found = members.join(saved(mixed.select(bucket, "least_n"), "mixed"), bucket)
    smallest_union = F.col("n") + F.greatest("least_n", "most") - F.col("most")
    return found.where(100 * F.col("most") >= per_cent * smallest_union).drop("least_n")


def _prefixes(nodes: DataFrame, texts: DataFrame, kind: str, size: int, per_cent: int) -> DataFrame:
    """The rarest shingles of each node, so many that two similar sets have one of them in common.

    ``most``: of two sets whose first common shingle this is, so many can be in both.
    """
    grams = saved(texts.join(nodes.select("id"), "id").mapInArrow(giving_back(_grams(size)), f"node {kind}, gram long"), "grams")
    counts = saved(grams.groupBy("gram").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1"), "counts")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("texts", F.lit(1)), "gram"))
    ordered = grams.join(counts, "gram", "left").withColumn("place", place)
    ordered = ordered.join(nodes.withColumnRenamed("id", "node"), "node")
    needed = F.col("n") - F.ceil(F.col("n") * per_cent / 100) + 1
    return ordered.where((F.col("place") <= needed) & F.col("texts").isNotNull()).select("gram", "node", "n", "group", (F.col("n") - F.col("place") + 1).cast("long").alias("most"))


def near_duplicates(
    documents: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle_words: int = 5,
    per_cent: int = 80,
    bands: int = BANDS,
    rows: int = ROWS,
    broadcast_ids: int = BROADCAST_IDS,
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id``, ``kept`` for every row, near copies joined to components.

    Words are split at white space, with A-Z in lower case. Two rows are linked
    when the Jaccard similarity of their sets of ``shingle_words``-word shingles
    is at least ``per_cent`` in 100; ``component_id`` is the smallest id that
    links reach, and ``kept`` marks the row that has it.

    1. Each text gives its set's size and digest, and its bands. Rows with one
       set are a class, stood for by its smallest id.
    2. Classes of a band are compared with the band's hub, its smallest member,
       on full sets, and links are joined to components.
    3. Classes of bands that still have several components are ordered by prefixes:
       two sets of the wanted similarity share one of their rarest shingles.
       Such a shingle is a bucket; its members are compared with 16 hubs, then
       1,024 and so on, until no bucket has members in several components. Pairs that are
       connected already need no comparison, so groups of near copies stay cheap;
       every other pair that can be linked is compared.

    Defined cases: a null, empty or blank text has no shingles and links with
    nothing; rows with a null id get the numbers of their text, a null component
    and ``kept`` true; a repeated row is repeated in the result. Ids are meant to
    be unique: of several texts under one id, the first in byte order stands for
    all when texts are compared. Other columns are ignored.
    """
    bounded_batches(documents.sparkSession)
    source = documents.select(F.col(id_column).alias("id"), F.col(text_column).cast("binary").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    signed = saved(source.mapInArrow(giving_back(_signatures(shingle_words, bands, rows)), f"id {kind}, n long, digest binary, bands array<long>"), "signatures")
    full = signed.where(F.col("digest").isNotNull() & F.col("id").isNotNull())
    classes = saved(full.groupBy("digest").agg(F.min("id").alias("node")), "classes")
    nodes = full.join(classes, "digest").where(F.col("id") == F.col("node"))
    listed = nodes.select("node", "n", F.explode("bands").alias("band")).distinct()
    members = saved(listed, "bands")
    crowded = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1").select("band")
    members = saved(members.join(saved(crowded, "crowded"), "band").withColumns({"group": F.col("node"), "most": F.col("n")}), "members")
    wanted = saved(members.select(F.col("node").alias("id")).distinct(), "wanted")
    texts = source.join(bounded_broadcast(wanted, wanted.count(), broadcast_ids), "id").groupBy("id").agg(F.min("text").alias("text"))
    texts = saved(texts, "texts")
    pairs = _pairs(members, _hubs(members, "band", 1), "band", per_cent)
    links = saved(_linked(pairs, texts, kind, shingle_words, per_cent), "links")
    groups = saved(connected(links, "a", "b").withColumnRenamed("component", "group"), "groups")
    rest = saved(_regrouped(members, groups), "rest")
    open_nodes = _mixed(rest, "band", per_cent).select(F.col("node").alias("id"), "n", "group").distinct()
    members = saved(_prefixes(saved(open_nodes, "open"), texts, kind, shingle_words, per_cent), "prefixes")
    members = saved(_mixed(members, "gram", per_cent), "members")
    hubs_drawn = 16
    while not members.isEmpty():
        hubs = _hubs(members, "gram", hubs_drawn)
        pairs = _pairs(members, hubs, "gram", per_cent)
        found = saved(_linked(pairs, texts, kind, shingle_words, per_cent), "found")
        if not found.isEmpty():
            links = saved(links.unionByName(found), "links")
            groups = saved(connected(links, "a", "b").withColumnRenamed("component", "group"), "groups")
        rest = members.join(hubs.select("gram", F.col("hub_node").alias("node")), ["gram", "node"], "left_anti")
        rest = saved(_regrouped(rest, groups), "rest")
        members = saved(_mixed(rest, "gram", per_cent), "members")
        hubs_drawn *= 64
    groups = groups.withColumnRenamed("group", "component_id")
    classes = saved(classes.join(groups, "node", "left").withColumn("component_id", F.coalesce("component_id", "node")), "classes")
    grouped = full.join(classes, "digest").select("id", F.col("n").alias("n_shingles"), "component_id")
    alone = signed.where(F.col("digest").isNull() | F.col("id").isNull()).select("id", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    out = grouped.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True))).withColumnRenamed("id", id_column)
