"""Phrase transducers, the learned entries against a plain recount, and scores at the threshold."""

import math
import random

import pytest

from fleetmart.llm import toxicity as X

LEXICON = X.Lexicon({w: (s, 1.0) for s, listed in X.FIXED.items() for w in listed.split()}, {})


def paid(text):
    return X.evidence(text, LEXICON, {})


def test_phrases_of_several_words():
    toxic = lambda text: 1 - math.exp(-paid(text)) >= X.THRESHOLD
    assert toxic("I will make you pay") and toxic("we will make them suffer") and toxic("You will regret this")
    assert toxic("what a waste of space") and toxic("You are a waste of space!") and toxic("go to hell")
    assert not toxic("a waste of time") and not toxic("the space to waste of it") and not toxic("make the payment") and not toxic("you will pay attention")
    assert paid("he said go to hell") < paid("go to hell") and paid("no waste of space") < paid("a waste of space")
    assert paid("You waste of space") > paid("a waste of space")  # aimed at a target
    assert not toxic("go to. hell") and not toxic("waste of, space")  # clauses end a phrase


@pytest.mark.parametrize("kind", [X.INSULT, X.THREAT])
def test_machine_marks_ends_of_phrases(kind):
    """Against a search for every phrase at every place, on words drawn from the phrases."""
    spelled = [tuple(X.TARGET if w == "TARGET" else X.PHRASE_WORDS[w] for w in p.split()) for p in X.PHRASES[kind]]
    machine = X.phrases(kind, X.PHRASES[kind], True)
    rng = random.Random(5)
    symbols = sorted({s for p in spelled for s in p}) + [X.OTHER]
    for _ in range(300):
        read = [s for _ in range(4) for s in (rng.choice(spelled)[: rng.randrange(1, 5)] if rng.random() < 0.6 else (rng.choice(symbols),))]
        state, wrote = 0, []
        for s in read:
            state, out, _ = machine.step[state, s]
            wrote.append(out)
        ends = {i for i in range(len(read)) for p in spelled if tuple(read[i + 1 - len(p) : i + 1]) == p and i + 1 >= len(p)}
        assert wrote == [kind if i in ends else s for i, s in enumerate(read)]


def test_words_keep_their_meaning_outside_phrases():
    for word, symbol in X.PHRASE_WORDS.items():
        assert X.clause_weight([(symbol, 1.0)]) == X.clause_weight([(X.BASE[symbol], 1.0)]), word


def test_entries_against_a_recount(spark):
    """Documents, neighbours, odds and bounds of every entry, counted one by one. Copies of a toxic text count once."""
    rng = random.Random(8)
    words = [f"{a}{b}{c}" for a in ("vlor", "zna", "gru", "mip") for b in ("pa", "xo", "ti") for c in ("", "n", "rt")]
    texts = []
    for _ in range(400):
        toxic = int(rng.random() < 0.3)
        texts.append((" ".join(rng.choice(words[:18] if toxic and rng.random() < 0.5 else words[9:]) for _ in range(rng.randrange(1, 15))), toxic))
    texts += [texts[0]] * 5 + [(t, 1) for t, y in texts if y][:20] + [(None, 0), ("", 1), (None, 1), ("x", None)]
    documents = [t or "" for t, y in texts if y == 0], sorted({t or "" for t, y in texts if y == 1})
    entries = {}
    for toxic, listed in enumerate(documents):
        for t in listed:
            own = [w for w in X.words_of(t) if w]
            for i, w in enumerate(own):
                for e in [w, *(w[:n] + "*" for n in X.STEMS if len(w) > n)]:
                    at = entries.setdefault(e, ([set(), set()], set(), set()))
                    at[0][toxic].add(id(t) if not toxic else t)
                    if toxic:
                        at[1].add(own[i - 1] if i else "")
                        at[2].add(own[i + 1] if i + 1 < len(own) else "")
    want = {}
    n_clean, n_toxic = len(documents[0]), len(documents[1])
    for e, (held, before, after) in entries.items():
        c, t = len(held[0]), len(held[1])
        odds = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        error = math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5))
        if t >= X.DOCUMENTS and min(len(before), len(after)) >= X.NEIGHBOURS and odds >= X.MIN_LOG_ODDS and odds - X.DEVIATIONS * error >= X.MIN_BOUND:
            want[e] = min(1.0, odds / 6) * t / (t + 8.0)
    lexicon = X.learn(spark.createDataFrame(texts, "text string, toxic int"))
    got = {w: x for w, (_, x) in lexicon.words.items() if w not in X.FIXED_WORDS} | {s + "*": x for s, x in lexicon.stems.items()}
    assert want and got.keys() == want.keys() and all(math.isclose(got[e], want[e]) for e in want)


def test_equal_scores_at_the_threshold(spark):
    """A document whose score is the threshold itself goes, as ``predicted`` says, and equal texts fare alike."""
    lexicon = X.Lexicon({"edge": (X.INSULT, X.ALONE)}, {})
    docs = spark.createDataFrame([(i, "edge") for i in range(3)] + [(3, "calm")], "doc_id long, text string")
    scored = {r.doc_id: r.score for r in X.score(docs, lexicon).collect()}
    assert scored[0] == scored[1] == scored[2] >= X.THRESHOLD - 1e-12
    kept = {r.doc_id for r in X.reject(docs, lexicon).collect()}
    assert kept == {i for i, s in scored.items() if s < X.THRESHOLD} and 3 in kept
