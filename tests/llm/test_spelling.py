"""Spelling variants against brute force: every kind of edit, ties, chains, halved partitions, long words, odd rows."""

import random
import re
import zlib
from collections import Counter

import pytest

from fleetmart.llm import spelling

LOWER = {i: i + 32 for i in range(65, 91)}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, ratio=10):
    forms = {}
    for w, n in counts.items():
        others = [o for o in counts if is_near(w, o)]
        best = min(others, key=lambda o: (-counts[o], o)) if others else None
        forms[w] = (len(others), best if best and counts[best] >= ratio * n else None)
    out = []
    for w, (n_near, form) in forms.items():
        root = w
        while forms[root][1]:
            root = forms[root][1]
        out.append((w, form, root, counts[w], n_near, counts[form] if form else None))
    return sorted(out)


def vocabulary(seed, letters="abé", sizes=(7, 10), n=150):
    rng = random.Random(seed)
    words = set()
    while len(words) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(*sizes)))
        words.add(w)
        for _ in range(rng.randrange(3)):
            i, c = rng.randrange(len(w)), rng.choice(letters)
            words.add(rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :], w + c]))
    return {w: rng.choice([2, 2, 3, 20, 25, 300, 4000]) for w in words if len(w) >= 7}


def got(df):
    return sorted(tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize(("seed", "limit"), [(1, spelling.PARTITION), (2, 1), (3, 4)])
def test_variants(spark, seed, limit):
    counts = vocabulary(seed) | {"x" * 7: 2, "x" * 8: 20, "x" * 9: 200, "x" * 10: 2000, "y" * 3000: 2, "y" * 2999: 20, "abcdefgh" * 400: 2, "abcdefgh" * 399 + "abcdeffh": 30}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got(spelling.variants(words, limit=limit)) == brute(counts)


def test_vocabulary(spark):
    rng = random.Random(4)
    runs = ["Wörter und Ümlaute", "ÀÉÎaaaaÿ×÷", "short", "exactly", "EXACTLY", "hyphen-ated-words", "tab\tletters\nletters", "naïveté" * 3, "x" * 50_000, "日本語letters日本"]
    texts = [" ".join(rng.choice(runs) for _ in range(rng.randrange(60))) for _ in range(60)]
    rows = [*enumerate(texts), (5, texts[5]), (None, texts[6]), (70, None), (71, ""), (72, " - ")]
    table = spark.createDataFrame([(i, t, "w", 1, "m") for i, t in rows], "doc_id long, text string, word string, n int, mid string")
    want = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER)):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            want[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    assert {r.word: r.n for r in spelling.vocabulary(table).collect()} == want
    assert got(spelling.variants(spelling.vocabulary(table))) == brute(want)
    plain = Counter(run for _, t in rows for run in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(LOWER)))
    assert {r.word: r.n for r in spelling.vocabulary(table, noise=None).collect()} == {w: n for w, n in plain.items() if len(w) >= 7 and n >= 2}


def test_small_counters_give_the_same_words(spark, monkeypatch):
    table = spark.createDataFrame([(i, f"letters number{'abcdefg'[i % 7]} letters") for i in range(40)], "doc_id long, text string")
    want = sorted(map(tuple, spelling.vocabulary(table).collect()))
    monkeypatch.setattr(spelling, "HELD", 1)
    assert sorted(map(tuple, spelling.vocabulary(table).collect())) == want


def test_empty(spark):
    assert got(spelling.variants(spelling.vocabulary(spark.createDataFrame([], "doc_id string, text string")))) == []


def test_acceptor_is_minimal():
    """One state for each distinct set of endings, and the words back."""
    words = sorted({w[:k] for w in vocabulary(9) for k in (3, len(w))} | {""})
    acceptor = spelling.Acceptor()
    start = acceptor.of(words)
    endings = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in {w[:k] for w in words for k in range(len(w) + 1)}}
    assert sorted(acceptor.language(start)) == words
    assert len(acceptor.arcs) == len(endings)


def test_pairs_come_once():
    """Each near pair of a partition has one path, also where letters repeat."""
    shorter = ["aaa", "aab", "aba", "baa", "abb", "éaa"]
    longer = ["aaaa", "aaba", "abab", "baaa", "aab", "éaaa", "aabb"]
    longer = [w for w in longer if len(w) == 4]
    found = list(spelling.pairs(shorter, longer, 4))
    want = [(0, u, 0, v) for u in shorter for v in shorter if u < v and is_near(u, v)] + [(0, u, 1, v) for u in shorter for v in longer if is_near(u, v)]
    assert len(found) == len(want)
    assert {(i, *sorted((u, v))) if j == 0 else (j, u, v) for i, u, j, v in found} == {(i, *sorted((u, v))) if j == 0 else (j, u, v) for i, u, j, v in want}


def test_partitions_are_bounded(spark):
    """Halving goes on until a partition fits or its edit has one place left."""
    counts = vocabulary(6, n=300)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    sizes = spelling.partitions(words, limit=8).groupBy("size", "lo", "hi", "left", "right").count().collect()
    assert max(r["count"] for r in sizes if r.hi - r.lo > 1) <= 8
    assert max(r["count"] for r in sizes) <= 3 + 3**2
