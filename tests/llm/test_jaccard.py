"""The Jaccard join against brute force: awkward rows, star-shaped groups, hot passages, cut regions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fleetmart.llm import jaccard

LOWER = {i: i + 32 for i in range(65, 91)}
SCHEMA = "doc_id long, text string, id string, a long, n long, s string, label long, c long, version int"


def docs(spark, texts):
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "x", 1, 2, "y", 3, 4, 5) for i, t in rows], SCHEMA)


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, size=5, percent=80):
    """component per row, ids linked through any of their texts."""
    sets = [shingles(t, size) for _, t in rows]
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if rows[i][0] is not None and rows[j][0] is not None and both and 100 * both >= percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    smallest = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            smallest[find(i)] = min(smallest.get(find(i), key), key)
    return sorted((str(k), len(sets[i]), str(smallest.get(find(i), k) if sets[i] and k is not None else k)) for i, (k, _) in enumerate(rows))


def prose(rng, n, vocabulary=500):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


@pytest.fixture(scope="module")
def corpus():
    """Copies, chains of edits, stars whose ends are apart, a passage that a third of the texts share, long texts."""
    rng = random.Random(11)
    passage = prose(rng, 40)
    texts = [None, "", " \n\t", "one", "ONE", "one two three", "One Two three", "a " * 200]
    for _ in range(6):
        base = prose(rng, rng.choice([60, 120, 300]))
        texts += [" ".join(edited(rng, base, k)) for k in (0, 0, 1, 1, 2, 3, 4, 5, 6, 7)]
    chain = prose(rng, 150)
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 2)
    texts += [" ".join(prose(rng, 25) + passage + prose(rng, 25)) for _ in range(40)]
    texts += [" ".join(edited(rng, passage, 1)) for _ in range(10)]
    texts.append(" ".join(prose(rng, 20_000, 9000)))
    texts.append(texts[-1] + " end")
    rows = list(enumerate(texts))
    return [*rows, (3, "other text of a repeated id"), (3, "one"), (None, "one"), (None, None)]


@pytest.mark.parametrize("region", [jaccard.REGION, 2000])
def test_components(spark, corpus, region):
    got = jaccard.join(docs(spark, corpus), region=region).collect()
    assert sorted(tuple(map(str, r)) for r in got) == sorted(tuple(map(str, r)) for r in brute(corpus))


def test_other_thresholds(spark, corpus):
    some = [r for r in corpus if r[1] is None or len(r[1]) < 3000]
    for size, percent in ((3, 60), (5, 95), (1, 80)):
        got = jaccard.join(docs(spark, some), size=size, percent=percent).collect()
        assert sorted(tuple(map(str, r)) for r in got) == sorted(tuple(map(str, r)) for r in brute(some, size, percent)), (size, percent)


def test_empty_table_and_text_ids(spark):
    assert jaccard.join(docs(spark, [])).collect() == []
    words = " ".join(map(str, range(50)))
    named = spark.createDataFrame([("b", words), ("a", words + " more"), ("c", "alone here")], "doc_id string, text string")
    assert sorted(map(tuple, jaccard.join(named).collect())) == [("a", 47, "a"), ("b", 46, "a"), ("c", 1, "c")]


def test_counts_of_shared_hashes_never_fall_short(spark, corpus):
    table = docs(spark, corpus)
    sets = {}
    for key, t in corpus:
        if key is not None and shingles(t):
            sets[frozenset(shingles(t))] = 0
    for s in sets:
        sets[s] = len({x for x in s if any(x in o for o in sets if o != s)})
    points = {r.a: r.n for r in jaccard.measured(table.filter("doc_id IS NOT NULL"), "doc_id", "text", 5).filter("n > 0").collect()}
    m = {r.a: r.m for r in jaccard.shared(table.filter("doc_id IS NOT NULL"), "text", 5, 1).collect()}
    assert sorted((points[a], m.get(a, 0)) for a in points) == sorted((len(s), n) for s, n in sets.items())


@pytest.mark.parametrize("seed", range(4))
def test_region_recursion(seed, monkeypatch):
    """Cells in a task give the links that comparing all outer sets with all residents gives."""
    rng = np.random.default_rng(seed)
    bases = [rng.choice(10**6, 100, replace=False) for _ in range(12)]
    sets = [np.unique(np.concatenate([rng.choice(b, 100 - k, replace=False), rng.choice(10**6, k)])) for b in bases for k in rng.integers(0, 25, 25)]
    pivot = set(bases[0].tolist())
    d = [1 - len(pivot & set(s.tolist())) / len(pivot | set(s.tolist())) for s in sets]
    flat = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets)))
    k = len(sets)
    table = pa.table({"a": list(range(k)), "label": list(range(k)), "d": d, "s": flat, "outer": [True] * k, "resident": [True] * k})
    want = list(range(k))

    def find(top, x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(k):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                want[find(want, i)] = find(want, j)
    for leaf in (10, 500, jaccard.LEAF):
        monkeypatch.setattr(jaccard, "LEAF", leaf)
        links = jaccard._joined(table, 80).to_pylist()
        got = list(range(k))
        for link in links:
            assert find(got, link["a"]) != find(got, link["b"]), "links don't repeat what is known"
            got[find(got, link["a"])] = find(got, link["b"])
        assert len({find(got, x) for x in range(k)}) == len({find(want, x) for x in range(k)}) < k
        assert all(find(want, link["a"]) == find(want, link["b"]) for link in links)


def test_texts_travel_compressed_and_anchors_are_stored_once(spark, monkeypatch):
    texts = [f"w{i} " * 3 + "of one long common passage of words that several texts have in one place " * 5 for i in range(40)]
    table, stored, sent, settle, zipped = docs(spark, [*texts, None, ""]), [], [], jaccard.settle, jaccard.zipped
    monkeypatch.setattr(jaccard, "settle", lambda df: stored.append(df.columns) or settle(df))
    monkeypatch.setattr(jaccard, "zipped", lambda df, text: sent.append(zipped(df, text)) or sent[-1])
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard.join(table).collect()) == brute(list(enumerate([*texts, None, ""])))
    assert ["h", "a", "n", "m"] in stored and len(sent) == 1
    held = {r.id: r.text for r in sent[0].collect()}
    assert held[40] is None and sum(map(len, filter(None, held.values()))) < sum(map(len, texts)) / 2
