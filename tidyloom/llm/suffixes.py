"""Repeated passages by suffix arrays, built by linear grouping.

The array of a text is built in two steps. Suffixes are grouped by their first
byte; groups are then processed in descending order, each once: every suffix
points to the previous one of a smaller group, and suffixes pointed to are moved
into a new group right above their old one. At the end each group holds the
suffixes that share a Lyndon prefix. Then the order inside the groups is emitted
in one ascending pass along the same pointers; nothing is renamed or sorted again.

Corpora are cut so that no task needs them whole. Each window of 100 bytes has
an anchor, its 32-byte string of least hash; equal windows have equal anchors.
Blocks of documents ask how often their anchors occur (as in
``interpolation``), anchors that occur once are dropped, and the stretches of
text around the others meet by anchor. Where different stretches share an
anchor, the suffix array of them tells which windows are equal.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from math import ceil
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidyloom.llm.interpolation import _from_planes, _planes, _table
from tidyloom.llm.store import bounded_broadcast, saved
from tidyloom.llm.words import mix, running_hash

WINDOW, ANCHOR = 100, 32
BLOCK_BYTES = 8 << 20
#: Occurrences of an anchor from which its windows are compared one by one, so that no task holds them all.
HOT_ANCHOR = 2000
#: Ids of copies, or of documents with a repeat, that are broadcast at most; more are joined by shuffle, texts included.
BROADCAST_IDS = 2_000_000


def lyndon_groups(text: bytes) -> tuple[list[list[int]], list[int]]:
    """Groups of suffixes by Lyndon prefix, ascending, and each suffix's pointer to the previous smaller one (-1: none)."""
    n = len(text)
    members: dict[int, list[int]] = {}
    for i, byte in enumerate(text):
        members.setdefault(byte, []).append(i)
    names = sorted(members)
    groups = [members[b] for b in names]  # by number; more are added
    number = {b: g for g, b in enumerate(names)}
    of = [number[b] for b in text]
    above, below = [g + 1 for g in range(len(groups))], [g - 1 for g in range(len(groups))]
    if groups:
        above[-1] = -1
    previous, done = [-1] * n, bytearray(n)
    current, bottom = len(groups) - 1, 0
    order = []
    while current >= 0:
        own = [s for s in groups[current] if of[s] == current]
        groups[current] = own
        own.sort()
        pointed: dict[int, int] = {}
        for s in own:
            p = s - 1
            while p >= 0 and done[p]:
                p = previous[p]
            previous[s] = p
            done[s] = 1
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        if pointed:
            by_count: dict[int, list[int]] = {}
            for p, count in pointed.items():
                by_count.setdefault(count, []).append(p)
            for count in sorted(by_count, reverse=True):  # the one followed by most copies of the prefix is the largest
                moved: dict[int, int] = {}
                for p in by_count[count]:
                    old = of[p]
                    new = moved.get(old)
                    if new is None:
                        new = moved[old] = len(groups)
                        groups.append([])
                        up = above[old]
                        above.append(up)
                        below.append(old)
                        above[old] = new
                        below[up] = new
                    groups[new].append(p)
                    of[p] = new
        order.append(current)
        current = below[current]
    return [groups[g] for g in reversed(order) if groups[g]], previous


def suffix_array(text: bytes) -> list[int]:
    """Starts of all suffixes in ascending order."""
    groups, previous = lyndon_groups(text)
    n, slot, free, start = len(text), [0] * len(text), [], 0
    for g, own in enumerate(groups):
        for s in own:
            slot[s] = g
        free.append(start)
        start += len(own)
    out, placed = [-1] * n, bytearray(n)

    def place(t: int) -> None:
        # Suffixes whose Lyndon prefix ends where t begins come next in their groups.
        s = t - 1
        while s >= 0 and not placed[s]:
            placed[s] = 1
            g = slot[s]
            out[free[g]] = s
            free[g] += 1
            s = previous[s]

    place(n)
    for i in range(n):
        place(out[i])
    return out


def equal_windows(strings: list[bytes]) -> list[list[tuple[int, int]]]:
    """Classes of equal windows, of two or more places (string, start), by the suffix array of all strings."""
    text = b"\x00".join(strings)
    begins = np.cumsum([0] + [len(s) + 1 for s in strings])
    owner = np.repeat(np.arange(len(strings)), [len(s) + 1 for s in strings])
    array = np.array(suffix_array(text), dtype=np.int64)
    own = owner[array]
    places = array[array + WINDOW <= begins[own + 1] - 1]  # whole windows of one string
    out, held, last = [], [], None
    for at in places.tolist():
        window = text[at : at + WINDOW]
        if window != last:
            if len(held) > 1:
                out.append(held)
            held, last = [], window
        held.append((int(owner[at]), at - int(begins[owner[at]])))
    return [*out, held] if len(held) > 1 else out


_PIECE = 1 << 20


def anchors(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor of every window of a text: hash, place, first and last window start.

    The anchor is the gram of least hash (its upper 44 bits), the first among equals.
    """
    data = np.frombuffer(blob, dtype=np.uint8)
    sums, down = running_hash(data)
    grams = len(data) - ANCHOR + 1
    hashes = mix((sums[ANCHOR:] - sums[:grams]) * down[:grams])
    span = WINDOW - ANCHOR + 1  # grams of a window
    out = []
    for begin in range(0, grams - span + 1, _PIECE - span):
        piece = hashes[begin : begin + _PIECE - 1]
        # Place and hash in one number: a running minimum, by doubling widths, finds both.
        least = (piece & ~np.uint64(_PIECE - 1)) | np.arange(len(piece), dtype=np.uint64)
        count, width = len(piece) - span + 1, 1
        while width * 2 <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        least = np.minimum(least[:count], least[span - width : span - width + count])
        place = (least & np.uint64(_PIECE - 1)).astype(np.int64) + begin
        first = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        last = np.concatenate((first[1:], [count])) - 1
        # Least hashes are small numbers: they are mixed again, so that they spread over all parts.
        out.append((mix(hashes[place[first]]), place[first], first + begin, last + begin))
    return tuple(np.concatenate(columns) for columns in zip(*out))


def _documents(docs: pa.Table) -> list[tuple]:
    """Id and text of each document of a block, in order: rows with both in common are one document and do not repeat each other."""
    return sorted(set(zip(docs.column("id").to_pylist(), docs.column("text").to_pylist())))


def _asked(parts: int):
    """The anchors of a block: hash, and occurrences in the block, for each part."""

    def run(key: tuple, docs: pa.Table) -> pa.Table:
        found = [anchors(b)[0] for _, b in _documents(docs)]
        keys, counts = np.unique(np.concatenate(found), return_counts=True) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))
        part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        cuts = np.flatnonzero(np.diff(part)) + 1
        rows = [
            (key[0].as_py(), int(part[lo]), _planes(keys[lo:hi], "<u8"), _planes(counts[lo:hi], "<u4"))
            for lo, hi in zip([0, *cuts], [*cuts, len(keys)])
            if hi > lo
        ]
        return _table(rows, ("block", "part", "keys", "counts"), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))

    return run


def _told(hot: int):
    """For every block the anchors that occur more than once in all, and those that are hot."""

    def run(key: tuple, sent: pa.Table) -> pa.Table:
        part = key[0].as_py()
        keys = [_from_planes(b, "<u8") for b in sent.column("keys").to_pylist()]
        every = np.concatenate(keys)
        seen, back = np.unique(every, return_inverse=True)
        total = np.bincount(back, weights=np.concatenate([_from_planes(b, "<u4") for b in sent.column("counts").to_pylist()]))[back]
        rows, at = [], 0
        for block, own in zip(sent.column("block").to_pylist(), keys):
            counts = total[at : at + len(own)]
            at += len(own)
            rows.append((block, part, _planes(own[counts > 1], "<u8"), _planes(own[counts >= hot], "<u8")))
        return _table(rows, ("block", "part", "repeated", "hot"), (pa.int64(), pa.int64(), pa.binary(), pa.binary()))

    return run


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places in as few ranges as can be, ascending."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], stop)
        else:
            out.append((start, stop))
    return out


def _among(keys: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which keys are in a sorted list."""
    if not len(known):
        return np.zeros(len(keys), dtype=bool)
    return known[np.minimum(np.searchsorted(known, keys), len(known) - 1)] == keys


#: A stretch of text around an anchor: all its windows, from ``start`` on; or one window of a hot anchor; or a stretch that is covered.
_STRETCH = (("kind", pa.int32()), ("key", pa.int64()), ("second", pa.int64()), ("id", None), ("start", pa.int64()), ("anchor", pa.int64()), ("stretch", pa.binary()))
_COVERED, _STRETCHES, _WINDOWS = 0, 1, 2


def _stretches(id_type: pa.DataType):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        read = lambda name: np.sort(np.concatenate([_from_planes(b, "<u8") for b in told.column(name).to_pylist()] or [np.empty(0, np.uint64)]))
        repeated, hot = read("repeated"), read("hot")
        seen: dict[tuple, tuple] = {}
        rows: list[tuple] = []
        windows: dict[bytes, tuple] = {}
        for doc, blob in _documents(docs):
            ranges: list[tuple[int, int]] = []
            keys, places, firsts, lasts = anchors(blob)
            kept = np.flatnonzero(_among(keys, repeated))
            is_hot = _among(keys[kept], hot)
            for i, burning in zip(kept.tolist(), is_hot.tolist()):
                first, last = int(firsts[i]), int(lasts[i])
                stretch = blob[first : last + WINDOW]
                name = (stretch, int(places[i]) - first)
                if name in seen:  # documents come in order: an equal stretch was earlier
                    ranges.append((first, last + WINDOW))
                    continue
                seen[name] = (doc, first)
                if not burning:
                    rows.append((_STRETCHES, int(keys[i].view(np.int64)), 0, doc, first, int(places[i]) - first, stretch))
                    continue
                for at in range(first, last + 1):
                    window = blob[at : at + WINDOW]
                    if window in windows:
                        ranges.append((at, at + WINDOW))
                    else:
                        windows[window] = (doc, at)
            rows += [(_COVERED, 0, 0, doc, start, stop, None) for start, stop in _merged(ranges)]
        for window, (doc, at) in windows.items():
            a, b = np.frombuffer(hashlib.blake2b(window, digest_size=16).digest(), dtype=np.int64).tolist()
            rows.append((_WINDOWS, a, b, doc, at, 0, None))
        return _table(rows, [n for n, _ in _STRETCH], [k or id_type for _, k in _STRETCH])

    return run


def _trimmed(stretches: list[tuple]) -> list[tuple]:
    """The windows of each stretch (id, start, anchor, bytes) that can occur in another one of the same anchor: (id, start, bytes), maybe none.

    Neighbours in the order of what follows the anchor, and of what goes before it
    read backwards, share most of it.
    """
    right = sorted(range(len(stretches)), key=lambda i: stretches[i][3][stretches[i][2] :])
    left = sorted(range(len(stretches)), key=lambda i: stretches[i][3][: stretches[i][2]][::-1])
    reach = [[0, 0] for _ in stretches]
    for side, order in ((0, left), (1, right)):
        for i, j in zip(order, order[1:]):
            cut = [stretches[k][3][: stretches[k][2]][::-1] if side == 0 else stretches[k][3][stretches[k][2] :] for k in (i, j)]
            shared = len(commonprefix(cut))
            reach[i][side], reach[j][side] = max(reach[i][side], shared), max(reach[j][side], shared)
    out = []
    for (doc, start, anchor, stretch), (before, after) in zip(stretches, reach):
        first, last = max(0, anchor - before), min(len(stretch) - WINDOW, anchor + after - WINDOW)
        if first <= last:
            out.append((doc, start + first, stretch[first : last + WINDOW]))
    return out


_SORTED_AT_ONCE = 1 << 16


def _compared(id_type: pa.DataType):
    """Covered ranges of the stretches of one part: equal ones first, the others by the suffix array."""

    def run(key: tuple, part: pa.Table) -> pa.Table:
        groups = defaultdict(list)
        for k, doc, start, anchor, stretch in zip(*(part.column(c).to_pylist() for c in ("key", "id", "start", "anchor", "stretch"))):
            groups[k].append((doc, start, anchor, stretch))
        rows: list[tuple] = []
        strings: list[bytes] = []
        homes: list[tuple] = []

        def flush() -> None:
            for places in equal_windows(strings):
                least = min((homes[s][0], homes[s][1] + at) for s, at in places)
                for s, at in places:
                    doc, start = homes[s]
                    if (doc, start + at) != least:
                        rows.append((doc, start + at, start + at + WINDOW))
            strings.clear()
            homes.clear()

        for stretches in groups.values():
            if len(stretches) < 2:
                continue
            distinct: dict[tuple, tuple] = {}
            for doc, start, stretch in sorted(_trimmed(stretches), key=lambda s: (s[0], s[1])):
                if stretch in distinct:
                    rows.append((doc, start, start + len(stretch)))
                else:
                    distinct[stretch] = (doc, start)
            if len(distinct) > 1:
                strings += distinct
                homes += distinct.values()
                if sum(map(len, strings)) > _SORTED_AT_ONCE:
                    flush()
        if strings:
            flush()
        by_doc = defaultdict(list)
        for doc, start, stop in rows:
            by_doc[doc].append((start, stop))
        rows = [(doc, *span) for doc, ranges in by_doc.items() for span in _merged(ranges)]
        return _table(rows, ("id", "start", "stop"), (id_type, pa.int64(), pa.int64()))

    return run


def _cut(id_type: pa.DataType):
    """What is left of each text of a block without its covered ranges."""

    def run(docs: pa.Table, covered: pa.Table) -> pa.Table:
        ranges = defaultdict(list)
        for doc, start, stop in zip(*(covered.column(c).to_pylist() for c in ("id", "start", "stop"))):
            ranges[doc].append((start, stop))
        rows = []
        for doc, blob in zip(docs.column("id").to_pylist(), docs.column("text").to_pylist()):
            spans, kept, at = [{"start": start, "end": stop} for start, stop in _merged(ranges.get(doc, []))], [], 0
            for span in spans:
                kept.append(blob[at : span["start"]])
                at = span["end"]
            rows.append((doc, len(blob), spans, b"".join([*kept, blob[at:]])))
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return _table(rows, ("id", "n_bytes", "spans", "kept"), (id_type, pa.int64(), spans_type, pa.binary()))

    return run


def without_repeats(
    documents: DataFrame, id_column: str = "doc_id", text_column: str = "text", block_bytes: int = BLOCK_BYTES, hot_anchor: int = HOT_ANCHOR, broadcast_ids: int = BROADCAST_IDS
) -> DataFrame:
    """The id, ``n_bytes``, ``spans`` (removed byte ranges, ascending and apart) and ``kept`` (remaining bytes) for every row.

    A byte is removed when a 100-byte string over it also starts earlier, in a
    document of smaller id or further to the front of its own. Matches never
    cross documents and are judged on the input.

    Equal texts are one document, the one of smallest id; the others are removed
    whole where they have 100 bytes. In ``blocks`` of documents, equal stretches are
    found at once; the rest goes to the anchor's part, is trimmed to what a stretch can
    share with another, and is ordered by the suffix array. Anchors with ``hot_anchor`` or
    more occurrences send their windows, each once for each block, to be compared by key.

    Defined cases: null and empty texts, and texts under 100 bytes, are left as
    they are; rows with a null id are left as they are and remove nothing; a
    repeated row is one document and returned as often; ids are meant to be
    unique. An empty table gives no row. Other columns are ignored.
    """
    kind = documents.select(id_column).schema[0].dataType
    name, arrow = kind.simpleString(), to_arrow_type(kind)
    text = F.coalesce(F.col(text_column).cast("binary"), F.lit(b""))
    source = documents.select(F.col(id_column).alias("id"), text.alias("text"))
    total_bytes = source.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(1, ceil(total_bytes / block_bytes))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block")
    long = source.where(F.col("id").isNotNull() & (F.octet_length("text") >= WINDOW))
    digests = saved(long.select("id", F.sha2("text", 256).alias("digest")), "digests")
    firsts = saved(digests.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1"), "firsts")
    copies = saved(digests.join(firsts, "digest").where(F.col("id") > F.col("first")).select("id").distinct(), "copies")
    copies = bounded_broadcast(copies, copies.count(), broadcast_ids)
    docs = long.join(copies, "id", "left_anti").select(block, "id", "text")
    asked = docs.groupBy("block").applyInArrow(_asked(blocks), "block long, part long, keys binary, counts binary")
    told = saved(asked.groupBy("part").applyInArrow(_told(hot_anchor), "block long, part long, repeated binary, hot binary"), "told")
    found = docs.groupBy("block").cogroup(told.groupBy("block"))
    found = saved(found.applyInArrow(_stretches(arrow), f"kind int, key long, second long, id {name}, start long, anchor long, stretch binary"), "stretches")
    covered = found.where(F.col("kind") == _COVERED).select("id", "start", F.col("anchor").alias("stop"))
    meeting = found.where(F.col("kind") == _STRETCHES).select(F.pmod(F.col("key"), F.lit(max(blocks, 64))).alias("part"), "key", "id", "start", "anchor", "stretch")
    by_array = meeting.groupBy("part").applyInArrow(_compared(arrow), f"id {name}, start long, stop long")
    windows = found.where(F.col("kind") == _WINDOWS).select("key", "second", "id", "start")
    least = saved(windows.groupBy("key", "second").agg(F.min(F.struct("id", "start")).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1"), "least")
    by_key = windows.join(least, ["key", "second"]).where(F.struct("id", "start") > F.col("least")).select("id", "start", (F.col("start") + WINDOW).alias("stop"))
    covered = saved(covered.unionByName(by_array).unionByName(by_key), "covered")
    touched = saved(covered.select("id").distinct(), "touched")
    touched = bounded_broadcast(touched, touched.count(), broadcast_ids)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.octet_length("text").cast("long").alias("end")))
    shape = f"id {name}, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    cut = docs.join(touched, "id").select("block", "id", "text").groupBy("block").cogroup(covered.withColumn("block", block).groupBy("block"))
    cut = cut.applyInArrow(_cut(arrow), shape)
    size = F.octet_length("text").cast("long").alias("n_bytes")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    gone = long.join(copies, "id", "left_semi").select("id", size, whole.alias("spans"), F.lit(b"").alias("kept"))
    same = long.join(copies, "id", "left_anti").join(touched, "id", "left_anti").select("id", size, none, F.col("text").alias("kept"))
    short = source.where(F.col("id").isNull() | (F.octet_length("text") < WINDOW)).select("id", size, none, F.col("text").alias("kept"))
    return cut.unionByName(gone).unionByName(same).unionByName(short).withColumnRenamed("id", id_column)
