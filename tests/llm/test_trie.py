"""The prefix trie against brute force: shared beginnings, deep and turnless conversations, copies, nulls, ties."""

import hashlib
import random
import zlib

import pytest

from fleetmart.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, d long, conv string, owner int, i int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], schema)


def ordered(rows):
    found = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            found.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(ts)] for c, ts in found.items()}


def branched(found):
    out = {}
    for c, own in found.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = found.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(found):
    nodes = {}
    for c, path in found.items():
        for d in range(len(path) + 1):
            nodes.setdefault(tuple(path[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for path in nodes:
        if path:
            children[path[:-1]] = children.get(path[:-1], 0) + 1
    for path, members in nodes.items():
        for d in range(len(path) + 1):
            above = path[:d]
            leaves[above] = leaves.get(above, 0) + (path not in children)
            saved[above] = saved.get(above, 0) + ((len(members) - 1) * len(path[-1][1]) if path else 0)
    rows = []
    for path, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(found[c]) == len(path)))
        parent = min(nodes[path[:-1]]) if path else None
        rows.append((min(members), len(path), parent, len(members), children.get(path, 0), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = []
    for c in [*range(0, 40), *range(100, 130), *range(205, 215), 1000]:
        for t in range(rng.randrange(1, 9)):
            out.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["hi", "hé 日本", "", "x" * 50])))
    out += [(300 + c, t, "user", f"same {t}") for c in range(20) for t in range(5)]
    out += [(2000, t, "user", f"deep {t}") for t in range(75)] + [(2001, t, "user", f"deep {min(t, 40)}") for t in range(60)]
    out += [(3000, None, "user", "first"), (3000, 1, None, "tie"), (3000, 1, "a", None), (3000, 1, "a", None), (3001, None, None, None), (None, 0, "user", "lost")]
    out += [(400 + c, 0, "user", "short") for c in range(6)]  # some of them are turnless once rebuilt
    out += [(5000, 0, "user", "very long " * 30_000), (5000, 1, "ab", "c"), (5001, 0, "user", "very long " * 30_000), (5001, 1, "a", "bc")]
    return out


@pytest.mark.parametrize("height", [2, 4, 100])
def test_trie(spark, rows, height):
    assert got(trie.trie(table(spark, rows), height=height)) == brute(ordered(rows))


def test_rebuilt(spark, rows):
    found = branched(ordered(rows))
    assert any(not path for path in found.values())
    assert got(trie.nodes(*trie.rebuilt(trie.turns(table(spark, rows))))) == brute(found)


def test_names_that_are_texts_and_empty_tables(spark):
    rows = [("b", 0, "u", "x"), ("a", 0, "u", "x"), ("a", 1, "u", "y")]
    named = table(spark, rows, SCHEMA.replace("conv_id long", "conv_id string"))
    assert got(trie.trie(named)) == brute(ordered(rows))
    assert got(trie.trie(table(spark, []))) == [] == got(trie.nodes(*trie.rebuilt(trie.turns(table(spark, [])))))


def test_only_turnless_members(spark):
    rows = [(c, 0, "u", "t") for c in (401, 402, 403) if zlib.crc32(str(c).encode()) % 6]
    found = branched(ordered(rows))
    assert rows and not any(found.values())
    assert got(trie.nodes(*trie.rebuilt(trie.turns(table(spark, rows))))) == brute(found)


def test_pieces_are_hashed_in_order(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS owner", "id % 2 AS d", "id * 7919 % 100003 AS conv")
    want = {}
    for r in rows.collect():
        want.setdefault((r.owner, r.d), []).append(r.conv)
    want = sorted((o, d, hashlib.sha256(",".join(map(str, sorted(c))).encode()).hexdigest()) for (o, d), c in want.items())
    for limit in (1, 64, 1 << 20):
        assert sorted(map(tuple, trie.digests(rows, limit).collect())) == want


def test_bands_bound_rounds_and_rows(spark):
    """A node makes at most ``height`` rows, and a path of 64 nodes is folded in three levels of height four."""
    paths = spark.range(64).selectExpr("0L AS conv", "id AS i", "0L AS owner")
    own = spark.range(64).selectExpr("0L AS conv", "id AS i", "1L AS n")
    calls, inner = [], trie.rollup
    try:
        trie.rollup = lambda *a, **k: (calls.append(1), inner(*a, **k))[1]
        totals = {r.i: r.n for r in trie.rollup(paths, own, ["n"], 4).collect()}
    finally:
        trie.rollup = inner
    assert totals == {i: 64 - i for i in range(64)} and len(calls) == 3
