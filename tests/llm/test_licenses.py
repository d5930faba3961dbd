"""License spans against brute force: repeated phrases, lost and added words, long texts, overlapping places."""

import random
import re

from fleetmart.llm import licenses

LOWER = {i: i + 32 for i in range(65, 91)}


def brute(text):
    """(n_words, base places, labels, score) by looking at every place and every window of diagonals."""
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, labels, score = [], set(), 0.0
    for t in licenses.TEMPLATES:
        x = t.text.split()
        grams = [x[i : i + 3] for i in range(len(x) - 2)]
        hits = {}
        for at in range(len(w) - 2):
            for p, g in enumerate(grams):
                if w[at : at + 3] == g:
                    hits.setdefault(at - p, set()).add(p)
        if t.base:
            places += [(d, t.label) for d, ps in hits.items() if len(ps) == len(grams)]
        for d in hits:
            cover = len(set().union(*(hits.get(d + k, set()) for k in range(licenses.DRIFT + 1)))) / len(grams)
            score = max(score, cover)
            if cover >= licenses.COVER and not t.base:
                labels.add(t.label)
    base = {label for _, label in places}
    return len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None, sorted(base), sorted(base | labels), score


def texts():
    rng = random.Random(3)
    out = [None, "", "of the gnu " * 25, "public license " * 50, "all rights reserved " * 30, "under the mit license " * 400, "the gnu general public " * 60]
    filler = lambda n: " ".join(f"w{rng.randrange(300)}" for _ in range(n))
    for t in licenses.TEMPLATES[3:]:
        x = t.text.split()
        for _ in range(3):
            y = list(x)
            for _ in range(rng.randrange(5)):
                i = rng.randrange(len(y))
                y[i : i + 1] = rng.choice([[], [y[i], "extra"], ["other"]])
            out.append(f"{filler(rng.randrange(20))} {' '.join(y)}. {filler(5)} {' '.join(x[: rng.randrange(len(x))])}")
        out.append(" ".join(rng.sample(x, len(x))))  # the same words in another order
        out.append(" far ".join(" ".join(x[i : i + 4]) + " " + filler(15) for i in range(0, len(x), 4)))  # every part, but far apart
    out.append(filler(20_000) + " " + licenses.TEMPLATES[7].text + " " + filler(20_000))
    return out


def test_scan_equals_brute_force(spark):
    rows = list(enumerate(texts()))
    got = {r.doc_id: tuple(r)[1:] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, t in rows:
        assert got[i] == brute(t), (i, (t or "")[:200])
    assert got[2][4:6] == ([], []) and got[2][6] < 0.1  # a repeated phrase is one position
    assert any(g[5] for g in got.values()) and got[max(got)][5] == ["gpl"]


def test_spans_have_their_place(spark):
    gpl = next(t for t in licenses.TEMPLATES if t.label == "gpl")
    text = "one two three " + gpl.text.replace("free software", "very free software") + " four"
    found = licenses.spans(licenses.places(spark.createDataFrame([(1, text)], "doc_id long, text string"))).filter("label = 'gpl'").collect()
    best = max(found, key=lambda r: r.cover)
    assert (best.start, best.end) == (3, 3 + len(gpl.text.split()) + 1) and best.cover >= 0.8
