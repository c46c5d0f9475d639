"""Structure repair against a search over plain strings, on rows with every fault."""

import hashlib
import heapq
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cardinel.llm import edit_paths, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def cheapest(rows):
    """Least cost, then least letters, of (initial, must go, truncated) rows; every state once."""
    heap, done, found = [(0, "", 0, 0)], set(), []
    while heap:
        cost, letters, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in (0, 3):
            found.append((cost, letters))
        heapq.heappush(heap, (cost + 3, letters + "I", i, 3 if state == 2 else 2))
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            heapq.heappush(heap, (cost + 4, letters + "D", i + 1, state))
            if not must_go:
                more = 3 * truncated
                if initial in NEXT[state]:
                    heapq.heappush(heap, (cost + more, letters + "K", i + 1, NEXT[state][initial]))
                heapq.heappush(heap, (cost + 3 + more, letters + "R", i + 1, 3 if state == 2 else 2))
    return min(found)


def audited(rows):
    """The contract's row for each conversation of (conv_id, turn, role, text) rows."""
    after = {}
    for conv_id, turn, role, text in rows:
        own = after.setdefault(conv_id, [])
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        own += [(turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    out = []
    for conv_id, own in after.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, faults, rows = set(), [0, 0, 0], []
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            kind = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
            seen.add((role, text))
            if kind < 3:
                faults[kind] += 1
            rows.append((role[:1], kind < 2, kind == 2))
        initials = [r[0] for r in rows]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, letters = cheapest(rows)
        left, state, at = [], 0, iter(own)
        for letter in letters:
            if letter != "I":
                _, role, text = next(at)
            if letter == "D":
                continue
            if letter == "K":
                state = NEXT[state][role[:1]]
            else:
                state = 3 if state == 2 else 2
                role, text = "assistant" if state == 3 else "user", "" if letter == "I" else text
            left.append(f"{role}:{text}")
        digest = hashlib.sha256("\n".join(left).encode()).hexdigest()
        out.append((conv_id, gaps, *faults, illegal, cost, letters, digest))
    return sorted(out, key=repr)


def rows_of(seed, convs=60):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why? ", "cut", " ", "", None, "\x0b\t", "é…", "a.\n", "ok.", "x. y"]
    rows = []
    for conv in [None, *range(convs)]:
        for turn in draw.choice([range(9), range(3, 30, 3), [None, None, 2, 2, 7], range(0)]):
            role = draw.choice(["user", "assistant", "system", "", None, "tool", "User"])
            if draw.random() < 0.6 and turn is not None:
                role = "user" if turn % 2 == 0 else "assistant"
            rows.append((conv, turn, role, draw.choice(texts)))
    return rows


def tuples(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_audits_equal_a_search_over_strings(spark, seed, monkeypatch):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("gone", "blank", "again", "open", "initial", "_copy", "_times"):
        df = df.withColumn(name, F.lit("mine"))
    assert tuples(repair.audits(repair.damaged(df))) == audited(rows)


def test_nothing(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert repair.audits(repair.damaged(none)).count() == 0
    gone = spark.createDataFrame([(7, 0, "user", "x", True)], SCHEMA + ", gone boolean")
    empty = hashlib.sha256(b"").hexdigest()
    assert tuples(repair.audits(gone)) == [(7, 0, 0, 0, 0, 0, 0, "", empty)]


def test_repaired_turns_make_the_digest(spark):
    rows = rows_of(3)
    damaged = repair.damaged(spark.createDataFrame(rows, SCHEMA))
    turns = [r for r in repair.repaired_turns(damaged).collect() if r.position is not None]
    for conv_id, *_, digest in tuples(repair.audits(damaged)):
        own = sorted((r.position, r.role, r.text) for r in turns if r.conv_id == conv_id)
        text = "\n".join(f"{role}:{text}" for _, role, text in own)
        assert hashlib.sha256(text.encode()).hexdigest() == digest


def test_histories_let_go_and_collide(monkeypatch):
    draw = random.Random(5)

    def some(n):
        return [(draw.choice("suax"), draw.random() < 0.2, draw.random() < 0.3) for _ in range(n)]

    def got(rows):
        own = [edit_paths.Row(a, b"r", b"t", g, c) for a, g, c in rows]
        cost, edits = edit_paths.repaired(iter(own))
        return cost, "".join(letter for letter, _, _ in edits)

    for nodes, prime in ((4096, edit_paths.PRIME), (3, edit_paths.PRIME), (4096, 3), (5, 1)):
        # With a tiny modulus almost all hashes collide, and the letters decide.
        monkeypatch.setattr(edit_paths, "NODES", nodes)
        monkeypatch.setattr(edit_paths, "PRIME", prime)
        for _ in range(150):
            rows = some(draw.randint(0, 16))
            assert got(rows) == cheapest(rows)


def test_a_long_conversation_is_let_go_as_it_is_settled():
    at = []
    own = edit_paths.Repair(lambda *edit: at.append(edit))
    for i in range(60_000):
        own.add(edit_paths.Row("ua"[i % 2], b"r", b"t", i % 97 == 0, False))
    assert len(own.histories) < 20_000
    own.finish()
    assert sum(letter != "I" for letter, _, _ in at) == 60_000
