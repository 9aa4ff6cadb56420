"""Repair of conversations: the cheapest edits after which roles alternate, decided by integers alone.

Edits of a conversation are a path through a graph without cycles. A node is a
place between rows, the inserts made there, and a state of the role pattern
``(s?(ua)+)?``; an edge keeps (K), changes the role of (R), deletes (D) or
inserts (I) a message. A path's weight is one integer: its cost in the high
digits, and in the low digits, three bits to a letter from the first edit on, the
letters of its edits, with zeros behind the last. So of two paths the smaller
integer is the cheaper path, and of equally cheap ones that whose letters come
first. Equally cheap paths to one node never continue each other (an insert
costs something), hence the smaller one stays smaller whatever follows.

The same sum joins stretches: a stretch of a long conversation is a table of the
least integers from each state to each state. Stretches are worked on anywhere
and only their tables are put together in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from tidyloom.llm.store import saved

#: A conversation of more rows or bytes is worked on in stretches of so many rows.
LONG_ROWS, LONG_BYTES, STRETCH_ROWS = 4096, 8 << 20, 1024

COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3
# Three bits to a letter, in the order of ASCII; zero is the end.
_DIGIT = {"D": 1, "I": 2, "K": 3, "R": 4}
_LETTER = {digit: letter for letter, digit in _DIGIT.items()}
_BITS = 3

# States of the pattern: nothing yet, after s, after u, after a; what each role leads to.
START, SYSTEM, USER, ASSISTANT = range(4)
_STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_FINAL = (START, ASSISTANT)
_WANTED = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}  # the role that an insert or a change of role gives
_ROLES = {"u": "user", "a": "assistant"}
_LEGAL = {"su", "ua", "au"}
_BLANKS = " \t\n\x0b\x0c\r"


class Weights:
    """Sums of edges as integers, with room for so many letters below the cost."""

    def __init__(self, letters: int):
        self.low = _BITS * letters

    def edge(self, letter: str, place: int, extra: int = 0) -> int:
        return (COST[letter] + extra << self.low) + (_DIGIT[letter] << self.low - _BITS * (place + 1))


def best_paths(codes: list[tuple[str, bool, bool]], start: int) -> dict[int, tuple[int, str]]:
    """For each state that can be reached: the least cost from ``start`` and the letters of its edits.

    ``codes`` has for each row its role's initial, whether it must go, and whether it is truncated.
    """
    # Three inserts in a row only come back to a state, at a cost; two at one place are enough.
    weights = Weights(3 * len(codes) + 2)
    paths = _inserts({start: (0, 0)}, weights)
    for initial, must_go, truncated in codes:
        following: dict[int, tuple[int, int]] = {}
        extra = TRUNCATED_COST if truncated else 0
        for state, (weight, letters) in paths.items():
            _offer(following, state, weight + weights.edge("D", letters), letters + 1)
            if not must_go:
                kept = _STEP.get((state, initial))
                if kept is not None:
                    _offer(following, kept, weight + weights.edge("K", letters, extra), letters + 1)
                changed = _STEP[state, _WANTED[state]]
                _offer(following, changed, weight + weights.edge("R", letters, extra), letters + 1)
        paths = _inserts(following, weights)
    return {state: (weight >> weights.low, _letters(weight, weights.low, letters)) for state, (weight, letters) in paths.items()}


def _offer(paths: dict, state: int, weight: int, letters: int) -> None:
    if state not in paths or weight < paths[state][0]:
        paths[state] = weight, letters


def _inserts(paths: dict, weights: Weights) -> dict:
    before = paths
    paths = dict(paths)
    for _ in range(2):
        added: dict = {}
        for state, (weight, letters) in before.items():
            _offer(added, _STEP[state, _WANTED[state]], weight + weights.edge("I", letters), letters + 1)
        for state, path in added.items():
            _offer(paths, state, *path)
        before = added
    return paths


def _letters(weight: int, low: int, n: int) -> str:
    digits = (weight & (1 << low) - 1) >> low - _BITS * n
    return "".join(map(_LETTER.__getitem__, (int(d) for d in oct(digits)[2:]))) if n else ""


def joined(tables: Iterator[list[tuple[int, int, int, str]]], letters: int) -> tuple[int, str]:
    """Least cost and letters over stretches in order; a table holds (from, to, cost, letters).

    ``letters`` is a bound of the letters of all stretches together.
    """
    low = _BITS * letters
    paths = {START: (0, 0)}
    for table in tables:
        following: dict[int, tuple[int, int]] = {}
        for origin, state, cost, text in table:
            if origin in paths:
                weight, n = paths[origin]
                digits = int("".join(str(_DIGIT[letter]) for letter in text) or "0", 8)
                _offer(following, state, weight + (cost << low) + (digits << low - _BITS * (n + len(text))), n + len(text))
        paths = following
    weight, n = min(paths[state] for state in _FINAL if state in paths)
    return weight >> low, _letters(weight, low, n)


@dataclass
class Story:
    """What is counted of the rows of one conversation, in order; ``last`` carries on over stretches."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None
    last: str | None = None
    codes: list = field(default_factory=list)

    def add(self, role: str, text: str, seen_before: bool) -> None:
        bare = text.rstrip(_BLANKS)
        blank = not bare
        duplicate = not blank and seen_before
        truncated = not blank and not duplicate and bare[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        initial = role[:1]
        if self.first is None:
            self.first = initial
        elif self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        self.codes.append((initial, blank or duplicate, truncated))


class Repaired:
    """The digest of the repaired messages, fed in order with the letters of the edits."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state, self.digest, self.empty = audit, 0, START, hashlib.sha256(), True

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("" if self.empty else "\n") + f"{role}:{text}").encode())
        self.empty = False

    def inserts(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            wanted = _WANTED[self.state]
            self._write(_ROLES[wanted], "")
            self.state = _STEP[self.state, wanted]
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter != "D":
            wanted = role[:1] if letter == "K" else _WANTED[self.state]
            self._write(role if letter == "K" else _ROLES[wanted], text)
            self.state = _STEP[self.state, wanted]

    def end(self) -> str:
        self.inserts()
        return self.digest.hexdigest()


def damaged(conversations: DataFrame) -> tuple[Column, Column, Column]:
    """Role, text and how often the row stands there (0, 1, 2) after the damage that its number of conversation and turn asks for."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    case = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn"))) % 20
    text = F.when(case == 1, "").when(case == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    times = F.when(case == 0, 0).when(case == 3, 2).otherwise(1)
    return F.when(case == 4, "user").otherwise(blank("role")), text, times


def undamaged(conversations: DataFrame) -> tuple[Column, Column, Column]:
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    return blank("role"), blank("text"), F.lit(1)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _result(kind) -> StructType:
    texts = ("audit", "repaired_sha256")
    return StructType([StructField("conv_id", kind), *(StructField(n, LongType()) for n in _COUNTS), *(StructField(n, StringType()) for n in texts)])


def _batch(rows: list[tuple], schema: StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from batch.slice(at, 256).to_pylist()


def _gathered(rows: list[tuple], schema: StructType, most: int = 512) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(rows), most):
        yield _batch(rows[at : at + most], schema)


def _gaps(least: int | None, most: int | None, distinct: int) -> int:
    return 0 if least is None else most - least + 1 - distinct


def _whole(schema: StructType):
    """Conversations that fit a task's memory, one after the other in sorted order."""

    def one(key, rows: list[dict]) -> tuple:
        story, seen, turns, texts = Story(), set(), set(), []
        for row in rows:
            for _ in range(row["times"]):
                pair = row["role"], row["text"]
                story.add(*pair, pair in seen)
                seen.add(pair)
                texts.append(pair)
            if row["times"] and row["turn"] is not None:
                turns.add(row["turn"])
        ends = best_paths(story.codes, START)
        # Cost, then the letters: a shorter list that another one continues comes first.
        cost, audit = min(ends[state] for state in _FINAL if state in ends)
        repaired = Repaired(audit)
        for role, text in texts:
            repaired.row(role, text)
        gaps = _gaps(min(turns, default=None), max(turns, default=None), len(turns))
        return key, gaps, story.blank, story.duplicate, story.truncated, story.illegal, cost, audit, repaired.end()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, done = [], []
        for row in _stream(batches):
            if held and held[-1]["conv_id"] != row["conv_id"]:
                done.append(one(held[-1]["conv_id"], held))
                held = []
                if len(done) == 512:
                    yield _batch(done, schema)
                    done = []
            held.append(row)
        if held:
            done.append(one(held[-1]["conv_id"], held))
        if done:
            yield _batch(done, schema)

    return run


def _stretches(schema: StructType, size: int):
    """Tables of least weights and counts of consecutive rows of one conversation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        story, key, n = Story(), None, 0

        def close() -> pa.RecordBatch:
            table = [(origin, state, cost, letters) for origin in range(4) for state, (cost, letters) in best_paths(story.codes, origin).items()]
            row = (*key, n, story.blank, story.duplicate, story.truncated, story.illegal, story.first, story.last, len(story.codes), [dict(zip(("origin", "state", "cost", "letters"), t)) for t in table])
            return _batch([row], schema)

        for row in _stream(batches):
            here = row["conv_id"], row["range"]
            if story.codes and (here != key or len(story.codes) >= size):
                yield close()
                n, story = (n + 1 if here == key else 0), Story()
            elif here != key:
                n = 0
            key = here
            for i in range(row["times"]):
                story.add(row["role"], row["text"], i > 0 or not row["is_first"])
                if len(story.codes) >= size:
                    yield close()
                    n, story = n + 1, Story()
        if story.codes:
            yield close()

    return run


def _decided(schema: StructType):
    """Stretches of a conversation in order: counts added up, tables joined."""

    def one(key, parts: list[dict]) -> tuple:
        cost, audit = joined(([(t["origin"], t["state"], t["cost"], t["letters"]) for t in p["table"]] for p in parts), sum(3 * p["rows"] + 2 for p in parts))
        illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:]))
        return key, *(sum(p[name] for p in parts) for name in ("blank", "duplicate", "truncated")), illegal, cost, audit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for row in _stream(batches):
            if held and held[-1]["conv_id"] != row["conv_id"]:
                yield _batch([one(held[-1]["conv_id"], held)], schema)
                held = []
            held.append(row)
        if held:
            yield _batch([one(held[-1]["conv_id"], held)], schema)

    return run


def _digests(schema: StructType):
    """The letters of a conversation, then its rows: only the letters are held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repaired, key = None, None
        for row in _stream(batches):
            if row["audit"] is not None:
                if repaired:
                    yield _batch([(key, repaired.end())], schema)
                repaired, key = Repaired(row["audit"]), row["conv_id"]
            else:
                for _ in range(row["times"]):
                    repaired.row(row["role"], row["text"])
        if repaired:
            yield _batch([(key, repaired.end())], schema)

    return run


def _long(rows: DataFrame, size: int, result: StructType) -> DataFrame:
    """The same for conversations of any length: rows are spread by range, stretches are joined, and texts pass by once for the digest."""
    kind = result["conv_id"].dataType
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    turn = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    present = rows.where("times > 0")
    firsts = present.groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text")).agg(F.min(turn).alias("_first"))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("text") == F.col("_text"))
    present = present.join(firsts, same).select("conv_id", "turn", "role", "text", "times", (turn == F.col("_first")).alias("is_first"))
    # Borders of ranges come from a sample, so each row's range is written down with it.
    ranged = present.repartitionByRange("conv_id", "turn", "role", "text").sortWithinPartitions("conv_id", "turn", "role", "text")
    ranged = ranged.withColumn("range", F.spark_partition_id())
    table = "array<struct<origin: int, state: int, cost: long, letters: string>>"
    counts = "n long, blank long, duplicate long, truncated long, illegal long, first string, last string, rows long"
    stretch = StructType([StructField("conv_id", kind), *StructType.fromDDL(f"range int, {counts}, table {table}").fields])
    stretches = ranged.mapInArrow(_stretches(stretch, size), stretch)
    stretches = saved(stretches, "stretches").repartition("conv_id").sortWithinPartitions("conv_id", "range", "n")
    decided = StructType([StructField("conv_id", kind), *StructType.fromDDL("blank long, duplicate long, truncated long, illegal long, cost long, audit string").fields])
    decided = saved(stretches.mapInArrow(_decided(decided), decided), "decided")
    letters = decided.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("times"), "audit")
    texts = present.select("conv_id", "turn", "role", "text", F.col("times").cast("long"), F.lit(None).cast("string").alias("audit"))
    both = letters.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), "turn", "role", "text")
    digest = StructType([StructField("conv_id", kind), StructField("repaired_sha256", StringType())])
    digests = both.mapInArrow(_digests(digest), digest)
    distinct = present.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    out = rows.select("conv_id").distinct()
    for frame in (distinct, decided, digests):
        right = frame.withColumnRenamed("conv_id", "_conv")
        out = out.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    filled = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    return out.select("conv_id", *[F.coalesce(f.name, F.lit(filled.get(f.name, 0))).cast(f.dataType).alias(f.name) for f in result.fields[1:]])


def repaired_conversations(
    conversations: DataFrame,
    change=undamaged,
    long_rows: int = LONG_ROWS,
    long_bytes: int = LONG_BYTES,
    stretch_rows: int = STRETCH_ROWS,
) -> DataFrame:
    """One row for each ``conv_id``: faults of its rows, the cheapest repair and the digest of the repaired messages.

    Columns: ``gaps`` in the turns; ``blank``, ``duplicate`` and ``truncated``
    rows (the first fault of a row counts); ``illegal`` neighbours of roles;
    ``cost`` and ``audit`` (initials of Keep, Rerole, Delete, Insert in order) of
    the cheapest edits, ties ASCII-least; ``repaired_sha256`` of the repaired
    ``role:text`` joined by line ends. ``change`` gives role, text and number of
    repetitions of each row before it is read.

    Conversations of up to ``long_rows`` rows and ``long_bytes`` bytes are sorted
    by id and read one after the other, with one shuffle. Longer ones are split:
    see ``_long``. Only their digest has to be made in order, which a task does
    while the texts pass by; it holds the audit alone.

    Defined cases: rows stand in order of turn (nulls first), rows of one turn in
    order of role and text; a null role, text or number counts as one blank; a null
    ``conv_id`` is one conversation; repeated rows are duplicates; an empty
    role has no initial and is never kept; a conversation without rows after
    ``change`` has zeros, an empty audit and the digest of nothing; texts of any
    length are compared whole; an empty table gives no row. Other columns are ignored.
    """
    role, text, times = change(conversations)
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), times.cast("int").alias("times"))
    result = _result(rows.schema["conv_id"].dataType)
    sizes = rows.groupBy("conv_id").agg(F.sum("times").alias("rows"), F.sum(F.octet_length("text") * F.col("times")).alias("bytes"), F.count(F.lit(1)).alias("all"))
    large = sizes.where((F.col("rows") > long_rows) | (F.col("all") > long_rows) | (F.col("bytes") > long_bytes))
    large = saved(large.select(F.col("conv_id").alias("_conv")), "long-conversations")
    is_large = F.col("conv_id").eqNullSafe(F.col("_conv"))
    # What has no row any more still names its conversation.
    small = rows.withColumn("text", F.when(F.col("times") > 0, F.col("text")))
    small = small.join(large, is_large, "left_anti").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    found = small.mapInArrow(_whole(result), result)
    if not large.limit(1).count():
        return found
    long = saved(rows.join(large, is_large, "left_semi"), "long-rows")
    return found.unionByName(_long(long, stretch_rows, result))
