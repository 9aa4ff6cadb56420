"""The repair of conversations against a search over whole edit lists, whole and in stretches."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from conftest import TABLES

from tidyloom.llm import conversation_repair, queries

NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        case = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if case:
            text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
            out += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return out


def cheapest(rows):
    """Cost, letters and messages of the best edits: a search by (cost, letters) as they are read."""
    heap, closed = [(0, "", 0, "", ())], set()
    while heap:
        cost, letters, i, state, made = heapq.heappop(heap)
        if i == len(rows) and state in ("", "a"):
            return cost, letters, made
        if (i, state) in closed:
            continue
        closed.add((i, state))
        for initial, role in (("u", "user"), ("a", "assistant")):
            if (state, initial) in NEXT:
                heapq.heappush(heap, (cost + 3, letters + "I", i, NEXT[state, initial], made + ((role, ""),)))
        if i == len(rows):
            continue
        role, text, must_go, truncated = rows[i]
        heapq.heappush(heap, (cost + 4, letters + "D", i + 1, state, made))
        if not must_go:
            if (state, role[:1]) in NEXT:
                heapq.heappush(heap, (cost + 3 * truncated, letters + "K", i + 1, NEXT[state, role[:1]], made + ((role, text),)))
            for initial, new in (("u", "user"), ("a", "assistant")):
                if (state, initial) in NEXT:
                    heapq.heappush(heap, (cost + 3 + 3 * truncated, letters + "R", i + 1, NEXT[state, initial], made + ((new, text),)))


def plain(rows):
    after, out = damage(rows), []
    for conv in {r[0] for r in rows}:
        mine = sorted((r for r in after if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, faults, items = set(), [], []
        for _, _, role, text in mine:
            shown = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            faults.append(fault)
            items.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = {r[1] for r in mine if r[1] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:]))
        cost, letters, made = cheapest(items)
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in made).encode()).hexdigest()
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, letters, digest))
    return sorted(out, key=str)


def given(spark):
    return spark.read.parquet(f"{TABLES}/conversations.parquet").select("conv_id", "turn", "role", "text")


def made(spark):
    rng = random.Random(3)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "u"], ["Hi.", "Yes!", "no", "", None, " \t", "what?", "Long text. ", "word " * 30_000]
    rows = [
        (rng.choice([1, 2, 3, 4, 5, None]) if i < 300 else 7 + i // 3, rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts), "x", 1)
        for i in range(700)
    ]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, times string, range int")


@pytest.mark.parametrize("table", [given, made])
@pytest.mark.parametrize("sizes", [{}, {"long_rows": 2, "stretch_rows": 3}, {"long_rows": 0, "stretch_rows": 1}, {"long_bytes": 40, "stretch_rows": 100}])
def test_repair_equals_search(spark, table, sizes):
    frame = table(spark)
    expected = plain([tuple(r)[:4] for r in frame.collect()])
    assert sorted(map(tuple, conversation_repair.repaired_conversations(frame, conversation_repair.damaged, **sizes).collect()), key=str) == expected


def test_query(spark):
    assert sorted(map(tuple, queries.op11_repair(spark, TABLES).collect()), key=str) == plain([tuple(r) for r in given(spark).collect()])


def test_random_rows_decide_alike():
    rng = random.Random(5)
    for _ in range(400):
        rows = [(rng.choice(["user", "assistant", "system", "x", ""]), str(i), rng.random() < 0.2, rng.random() < 0.3) for i in range(rng.randrange(9))]
        codes = [(role[:1], must_go, truncated) for role, _, must_go, truncated in rows]
        cost, letters, _ = cheapest(rows)
        ends = conversation_repair.best_paths(codes, conversation_repair.START)
        assert min(ends[s] for s in (conversation_repair.START, conversation_repair.ASSISTANT) if s in ends) == (cost, letters)
        cuts = sorted(rng.choices(range(len(codes) + 1), k=2))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)])]
        tables = [[(o, s, *path) for o in range(4) for s, path in conversation_repair.best_paths(part, o).items()] for part in parts]
        assert conversation_repair.joined(iter(tables), 3 * len(codes) + 6) == (cost, letters)


def test_nothing_left_and_empty_table(spark):
    frame = spark.createDataFrame([(1, t, "user", "Hi.") for t in range(200) if zlib.crc32(f"1:{t}".encode()) % 20 == 0], "conv_id long, turn long, role string, text string")
    nothing = (1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    for sizes in ({}, {"long_rows": 0}):
        assert [tuple(r) for r in conversation_repair.repaired_conversations(frame, conversation_repair.damaged, **sizes).collect()] == [nothing]
        assert conversation_repair.repaired_conversations(frame.limit(0), **sizes).collect() == []
    kept = conversation_repair.repaired_conversations(frame.limit(1)).first()
    assert (kept["audit"], kept["cost"]) == ("KI", 3)
