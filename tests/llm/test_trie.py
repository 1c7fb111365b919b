"""The prefix trie against plain Python: families, turnless conversations, nulls, ties, conversations over many blocks, hot first turns."""

import hashlib
import random
import re
import zlib

import pytest

from tapeline.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows, family=20, heads=4):
    own = {}
    for c, t, r, x in rows:
        if c is not None:
            own.setdefault(c, []).append((t, r or "", x or ""))

    def turn_id(r, x):
        return hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).hexdigest()

    own = {c: [(r, x) for _, r, x in sorted(ts, key=lambda y: (y[0] is not None, y[0] or 0, turn_id(y[1], y[2])))] for c, ts in own.items()}
    made = {}
    for c, turns in own.items():
        k = zlib.crc32(str(c).encode()) % heads
        made[c] = own.get(c - int(c - family * int(c / family)), [])[:k] + turns[k:]
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, ms in members.items():
        mine = (len(ms) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] = saved.get(p[:d], 0) + mine
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
    out = []
    for p, ms in members.items():
        ends = ",".join(map(str, sorted(c for c in ms if len(made[c]) == len(p))))
        out.append((min(ms), len(p), min(members[p[:-1]]) if p else None, len(ms), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, trie.conversation_trie(df).collect()), key=str)


ODD = [
    (None, 0, "user", "no conversation"), (0, None, "user", "null turn first"), (0, 1, None, None), (0, 1, "user", ""), (0, 2, "user", "a b\tc"), (0, 2, "assistant", "a b c"), (0, 2, "assistant", "a b c"),
    (1, 5, "user", "x"), (2, 0, "user", "x"), (3, 0, "user", "word " * 50_000), (7, 0, "a", "b"), (7, 1, "ab", ""), (40, 0, "user", "x"), (41, 0, "user", "x"), (45, 0, "user", "x y"), (-3, 0, "user", "x"), (-21, 1, "user", "é   \x00"),
]


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    want = brute(ODD)
    assert got(df) == want
    assert got(df.selectExpr("*", "'mine' as pos", "'mine' as block", "'mine' as size", "'mine' as base")) == want


def test_empty_table(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("block", [2, 8])
def test_long_conversations_and_hot_starts(spark, block, monkeypatch):
    """Conversations of up to 40 turns that share long starts, a third of them equal, and a turn that most begin with."""
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "TURNS", [f"t{k}" for k in range(1, block + 1)])
    monkeypatch.setattr(trie, "RUN_IDS", 5)
    rnd = random.Random(block)
    rows = []
    for c in range(90):
        n = 9 if c % 3 == 0 else rnd.choice([1, 2, 7, 8, 9, 16, 17, 40])
        kind = 0 if c % 3 == 0 else rnd.randrange(3)
        rows += [(c, t, "user" if t % 2 else "assistant", f"turn {min(t, 30)} of {kind if t > 8 else 0}" + (" more" if c % 7 == 1 and t > 12 else "")) for t in range(n)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)
