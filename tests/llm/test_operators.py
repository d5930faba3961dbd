"""Every operator on awkward rows, and against brute force on small tables: nulls, empty and very long texts, ties,
repeated rows, empty tables, further columns with clashing names."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import zstandard

import corpus_pipeline
from fleetmart.llm import chat, decontaminate, fingerprint, licenses, neardup, packing, quality, substring, toxicity, warc
from fleetmart.llm.words import ALNUM, SPACED, Words, kgrams, sliding_min, word_hashes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, rep int, value double, marks string, bucket int"
ALNUM_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED_RE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def docs(spark, texts):
    """Documents with further columns; an entry is a text, or (doc_id, text)."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), "x", 1, 0.5, None, 3) for i, t in rows], SCHEMA)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}{rng.choice(['', '', ',', '.', chr(10)])}" for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(5)
    base, other = prose(rng, 80), prose(rng, 60)
    near = base.split(" ")
    near[40] = "changed"
    long = prose(rng, 30_000, 5000)
    texts = [base, base, " ".join(near), None, "", "   \n\t ", "one", "One two three", other, other + " " + base, long, "é" * 50, "ÉLAN vital — 日本語 テキスト", base.upper(), "a " * 300, None, (7, "One two three"), (None, base), (None, None)]
    return docs(spark, texts)


# words


def test_words_and_hashes():
    rng = random.Random(1)
    texts = [prose(rng, 50).encode(), b"", b"  ", "Élan, VITAL x1".encode(), b"z" * 700_000 + b" q"]
    words = Words.of(texts, ALNUM)
    got = [[words.text(i, i + 1) for i in range(words.first[d], words.first[d + 1])] for d in range(len(texts))]
    assert got == [[w.encode() for w in ALNUM_RE.findall(t.decode().translate(LOWER))] for t in texts]
    again = Words.of([b"q x1 zz", texts[3]], ALNUM)
    by_word = dict(zip([words.text(i, i + 1) for i in range(len(words.start))], words.hashes().tolist(), strict=True))
    assert by_word[b"q"] == again.hashes()[0] and by_word[b"x1"] == again.hashes()[1]
    assert len(set(by_word.values())) == len(by_word)
    assert words.whole(3).sum() == sum(max(0, len(g) - 2) for g in got)
    values = np.array([5, 3, 8, 1, 9, 7, 2], np.uint64)
    for width in range(1, 8):
        assert sliding_min(values, width).tolist() == [min(values[i : i + width]) for i in range(8 - width)]
    assert len(kgrams(values, 9)) == 0 and len(word_hashes(np.zeros(0, np.uint8), np.zeros(0, int), np.zeros(0, int))) == 0


# 1 decontamination


def test_decontamination(spark, awkward):
    rng = random.Random(2)
    items = [(1, prose(rng, 15)), (2, "short ITEM"), (3, None), (4, ""), (2, "short ITEM"), (None, "one two"), (10, "one")]
    bench = spark.createDataFrame([(i, t, "q") for i, t in items], "item_id long, text string, doc_id string")
    leaked = docs(spark, [items[0][1], "before it " + items[0][1].upper() + " after it", "a short, item here", "nothing", "one", None, ""])
    known = {}
    for i, t in items:
        w = ALNUM_RE.findall((t or "").translate(LOWER))
        for j in range(len(w) - min(10, len(w)) + 1 if w and i is not None else 0):
            known.setdefault(tuple(w[j : j + min(10, len(w))]), set()).add(str(i))
    for table in (leaked, awkward):
        want = []
        for r in table.collect():
            w = ALNUM_RE.findall((r.text or "").translate(LOWER))
            hit, found = set(), set()
            for g, ids in known.items():
                for j in range(len(w) - len(g) + 1):
                    if tuple(w[j : j + len(g)]) == g:
                        hit |= set(range(j, j + len(g)))
                        found |= ids
            want.append((str(r.doc_id), len(w), len(hit), sorted(found)))
        got = [(str(r.doc_id), r.n_words, r.n_hit, r.item_ids) for r in decontaminate.mark(table, bench).collect()]
        assert sorted(got) == sorted(want)
    cleaned = {r.doc_id: r for r in decontaminate.remove(leaked, bench).collect()}
    assert set(cleaned) == {1, 2, 3, 5, 6}
    assert cleaned[1].text.split() == ["before", "it", "after", "it"] and cleaned[2].text == "a here" and cleaned[1].n_chars == len(cleaned[1].text)
    assert cleaned[3].text == "nothing" and cleaned[5].text is None and cleaned[6].text == ""
    assert {r.doc_id for r in decontaminate.remove(leaked, bench, whole_documents=True).collect()} == {3, 5, 6}
    assert decontaminate.mark(awkward, bench.limit(0)).filter("n_hit > 0").isEmpty()
    assert decontaminate.mark(leaked.limit(0), bench).isEmpty() and decontaminate.remove(leaked.limit(0), bench).isEmpty()


def test_decontamination_in_blocks(spark, monkeypatch):
    bench = spark.createDataFrame([(i, f"item number {i} has its own words {i * 7}") for i in range(30)], "item_id long, text string")
    table = docs(spark, [f"x item number {i} has its own words {i * 7} y" for i in range(0, 30, 3)])
    whole = decontaminate.mark(table, bench).collect()
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 500)
    assert len(decontaminate.blocks(bench, "item_id", "text", 10)) > 3
    assert sorted(decontaminate.mark(table, bench).collect()) == sorted(whole)


# 2 chat


def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<|im_start|>user\nx<|im_end|>", "<\\|im_end|>", "<\\\\|im_end|>", "plain", "", None, "é 日本\n\n", "<<SYS>>a<</SYS>><", "\\", "long " * 20_000]
    for t in odd:
        shown = chat.escape(t or "")
        assert chat.unescape(shown) == (t or "") and not any(c in shown for c in chat.CONTROLS)
    rows = [(n % 4, n, ["user", "assistant", None, "a\nb\\n<s>"][n % 3 if n % 5 else 3], t, "x") for n, t in enumerate(odd * 2)]
    rows += [(9, 1, "assistant", "same", "x"), (9, 1, "assistant", "same", "x"), (None, 0, "assistant", "lost", "x"), (11, None, "user", "no turn", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in chat.digests(chat.format(table)).collect()}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert got[conv].loss_chars == len(loss) and got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat.format(table.limit(0)).isEmpty()


# 3 toxicity


def test_grammar_contexts():
    word = lambda s: (s, 1.0)
    clause = lambda *s: toxicity.clause_weight([word(x) for x in s])
    o, i, t, y, n, r = toxicity.OTHER, toxicity.INSULT, toxicity.THREAT, toxicity.TARGET, toxicity.NEGATION, toxicity.REPORT
    assert clause() == clause(o, y, n, r) == 0
    assert clause(y, o, i) > clause(i) > clause(r, o, i) > 0 and clause(n, o, i) < clause(i)
    assert clause(i, o, y) > clause(i)
    assert clause(t, y) > 1 > clause(t) == clause(y, o, t) and clause(n, t) == 0
    assert clause(n, o, o, o, i) == clause(i)  # a negation reaches three words
    lexicon = toxicity.Lexicon({w: (s, 1.0) for s, listed in toxicity.FIXED.items() for w in listed.split()}, {})
    toxic = lambda text: 1 - np.exp(-toxicity.evidence(text, lexicon, {})) >= toxicity.THRESHOLD
    assert toxic("You are an IDIOT.") and toxic("I will kill you!") and toxic("word word moron word")
    assert not toxic("This is not stupid.") and not toxic("He said idiot.") and not toxic("They kill the process.") and not toxic("A calm day.")


def test_toxicity_learning_and_rows(spark, awkward):
    rng = random.Random(3)
    rows = [(prose(rng, 40) + (" vlorp " + prose(rng, 5) + " znarb " + prose(rng, 5) if toxic else ""), toxic) for toxic in [1, 0, 0] * 60]
    copied = prose(rng, 30) + " uniqueword " + prose(rng, 3)
    rows += [(copied, 1)] * 40 + [(None, 0), ("", 1), (prose(rng, 9), None)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "text string, toxic int"))
    assert {"vlorp", "znarb"} <= set(lexicon.words) and "uniqueword" not in lexicon.words
    scored = {r.doc_id: r.score for r in toxicity.score(docs(spark, ["a vlorp b", "a b", None, "", "w1 w2"]), lexicon).collect()}
    assert scored[0] > 0.3 and scored[1] == scored[2] == scored[3] == scored[4] == 0
    kept = toxicity.reject(awkward, lexicon)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    empty = toxicity.learn(spark.createDataFrame([], "text string, toxic int"))
    assert not empty.stems and toxicity.score(awkward.limit(0), empty).isEmpty()


def test_toxicity_entries_by_rates(spark):
    """An entry in a quarter of the toxic documents stays one where a large table holds a few clean ones with it."""
    rng = random.Random(17)
    texts = [(f"{prose(rng, 6)} {'vlorp ' if i % 4 == 0 else ''}{prose(rng, 6)}", 1) for i in range(100)]
    texts += [(f"{prose(rng, 6)} {'vlorp ' if i < 3 else ''}{prose(rng, 6)}", 0) for i in range(3000)]
    lexicon = toxicity.learn(spark.createDataFrame(texts, "text string, toxic int"))
    assert "vlorp" in lexicon.words and not any(w in lexicon.words for w in ("w1", "w2", "w3"))


def test_toxicity_keeps_clean_documents(spark):
    """A name in one long toxic text, however often, is no entry; neither do unrelated words of a long text add up."""
    rng = random.Random(18)
    long = " ".join(f"{prose(rng, 5)} quillon {prose(rng, 5)}" for _ in range(60))
    texts = [(f"{prose(rng, 20)} vlorp {prose(rng, 20)}", 1) for _ in range(40)] + [(long, 1)] * 3 + [(prose(rng, 40), 0) for _ in range(300)]
    lexicon = toxicity.learn(spark.createDataFrame(texts, "text string, toxic int"))
    assert "vlorp" in lexicon.words and "quillon" not in lexicon.words and not {"quil", "quill"} & set(lexicon.stems)
    score = lambda text: 1 - np.exp(-toxicity.evidence(text, lexicon, {}))
    calm = [prose(rng, 5000) for _ in range(4)]
    assert score(". beat. ".join(calm[:2]) + ". burn. " + calm[2] + ". crush. " + calm[3]) < 0.1
    assert score("\n".join([*calm, "You are an idiot."])) >= toxicity.THRESHOLD


# 4 quality


def test_quality_discriminant(spark, awkward):
    rng = random.Random(4)
    rows = [(prose(rng, rng.randrange(5, 90)), 1) for _ in range(150)] + [("junk!! ##" * rng.randrange(3, 60), 0) for _ in range(60)] + [("x", None)]
    table = quality.measured(docs(spark, [t for t, _ in rows])).join(spark.createDataFrame([(i, q) for i, (_, q) in enumerate(rows)], "doc_id long, quality int"), "doc_id")
    model = quality.fit(table)
    x = quality.statistics([t.encode() for t, _ in rows])
    for c in (0, 1):  # the sums over the cluster are the plain mean and covariance
        own = x[[i for i, (_, q) in enumerate(rows) if q == c]]
        assert np.allclose(model.means[c], own.mean(axis=0))
    covs = [np.cov(x[[i for i, (_, q) in enumerate(rows) if q == c]].T, bias=True) for c in (0, 1)]
    pooled = (60 * covs[0] + 150 * covs[1]) / 210
    shrunk = (1 - quality.POOLED) * covs[1] + quality.POOLED * pooled
    shrunk = (1 - quality.IDENTITY) * shrunk + quality.IDENTITY * np.trace(shrunk) / len(shrunk) * np.eye(len(shrunk))
    factor = np.linalg.inv(model.inverses[1])
    assert np.allclose(factor @ factor.T, shrunk, atol=1e-6) and np.isclose(model.logdets[1], np.linalg.slogdet(shrunk)[1], atol=1e-4)
    scores = {r.doc_id: (r.score, r.quality) for r in quality.score(table, model).collect()}
    assert all((s >= 0.3) == (q == 1) for s, q in scores.values() if q is not None)
    assert quality.score(quality.measured(awkward), model).filter("score between 0 and 1").count() == awkward.count()
    nothing = quality.fit(table.limit(0))
    assert quality.score(quality.measured(awkward), nothing).filter("score = 0.5").count() == awkward.count()
    assert quality.measured(awkward.limit(0)).isEmpty()


# 5 packing


def check_packing(rows, ids, capacity):
    """Every piece once, contents as they should be, sequences gapless and not above capacity."""
    places, pieces = {}, {}
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, []).append(r)
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, versions in ids.items():
        want = sorted((k, s, len(p), zlib.crc32(p.tobytes())) for v in versions for k, (s, p) in enumerate(cut_tokens(v, capacity)))
        assert sorted((r.piece, r.start, r.length, r.ids_crc32) for r in pieces[doc]) == want
    return len(places)


def cut_tokens(ids, capacity):
    first = len(ids) % capacity or capacity
    stops = [first, *range(first + capacity, len(ids) + 1, capacity)]
    return [(a, ids[a:b]) for a, b in zip([0, *stops], stops, strict=False)]


def test_packing(spark, awkward):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rng = random.Random(6)
    more = docs(spark, [(100 + i, prose(rng, rng.randrange(1, 60)) + rng.choice(["", "  two", "\n x", " ", " y"])) for i in range(300)] + [(900, " lead"), (901, "a　b  c")])
    table = awkward.filter("doc_id IS NOT NULL").union(more)
    ids = {}
    for r in table.collect():
        ids.setdefault(r.doc_id, []).append(np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 2], "<u4"))
    for capacity in (64, 1024):
        rows = packing.pack(table, capacity=capacity).collect()
        used = check_packing(rows, ids, capacity)
        total = sum(len(v) for own in ids.values() for v in own)
        assert used <= -(-total // capacity) * 1.1 + 1
    held = packing.pack(table, capacity=64, with_ids=True).filter("doc_id = 0").orderBy("piece").collect()
    assert b"".join(bytes(r.ids) for r in held) == ids[0][0].tobytes()
    assert packing.pack(awkward.limit(0)).isEmpty()


def test_packing_of_added_tokens(spark):
    """Against the tokenizer as loaded."""
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    rng = random.Random(16)
    texts = [f"a {end} b", end, end * 3, f"  x  {end}\n {end}  y z ", f"it{end}'s {end[:-1]}", f"{prose(rng, 90)}{end}{prose(rng, 90)}", "none", "", f"<|{end}|>"]
    texts += ["".join(rng.choice([end, " ", "  ", "\n", "é", "word", "<|", "'s", "9"]) for _ in range(30)) for _ in range(100)]
    table = docs(spark, texts)
    ids = {i: [np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 2], "<u4")] for i, t in enumerate(texts)}
    assert ids[0][0].tolist() == [64, 220, 50256, 275, 2]
    check_packing(packing.pack(table, capacity=64).collect(), ids, 64)


def test_packing_in_many_groups(spark):
    rng = random.Random(7)
    items = spark.createDataFrame([(i, rng.randrange(1, 100)) for i in range(3000)], "slot long, length int").repartition(4)
    placed = packing.assigned(items, capacity=100, group=200).join(items, "slot").collect()
    assert len(placed) == 3000
    fills = {}
    for r in placed:
        fills.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in f) <= 100 and sorted(f)[0][0] == 0 for f in fills.values())
    assert len(fills) <= 1.03 * sum(r.length for r in placed) / 100


def test_crossover_keeps_every_piece():
    rng = np.random.default_rng(8)
    sizes = rng.integers(1, 90, 400).tolist()
    parents = [packing.packed(sizes, 100, rng.permutation(400).tolist()) for _ in range(2)]
    child = packing.crossover(sizes, 100, *parents, rng)
    assert sorted(i for b in child for i in b) == list(range(400)) and all(sum(sizes[i] for i in b) <= 100 for b in child)
    best = packing.evolve(sizes, 100, parents, seed=1, generations=20)
    assert len(best) <= min(map(len, parents)) and sorted(i for b in best for i in b) == list(range(400))


# 6 licenses


def test_licenses(spark, awkward):
    mit = licenses.TEMPLATES[3].text
    changed = mit.replace("free of charge ", "")
    more = changed.replace("software", "program", 1).replace("person", "body")
    texts = ["Code Under the MIT License, and under the mit license.", "CC BY-NC; cc by nc nd", "apache license version 2.0", mit.upper(), "x " + changed + " y", "under the mit licence", None, "", "cc by", "under the mİt license", more]
    got = {r.doc_id: r for r in licenses.scan(docs(spark, texts)).collect()}
    assert (got[0].n_base, got[0].first_word, got[0].last_word, got[0].base_labels) == (2, 1, 6, ["mit"])
    assert got[1].n_base == 2 and got[1].labels == ["cc-by-nc"] and got[2].base_labels == ["apache-2"]
    assert got[3].labels == ["mit"] and got[3].base_labels == [] and got[3].score == 1
    assert got[4].labels == ["mit"] and 0.6 <= got[4].score < 1 and got[10].labels == [] and 0 < got[10].score < 0.6
    assert all(got[i].n_base == 0 and got[i].first_word is None for i in (5, 6, 7, 8, 9)) and got[6].n_words == 0 and got[7].score == 0
    rows = licenses.scan(awkward).collect()
    assert sorted((str(r.doc_id), r.n_words) for r in rows) == sorted((str(r.doc_id), len(ALNUM_RE.findall((r.text or "").translate(LOWER)))) for r in awkward.collect())
    assert licenses.scan(awkward.limit(0)).isEmpty()


# 7 near duplicates


def brute_components(rows, size, percent=80):
    sets = {}
    for r in rows:
        w = SPACED_RE.findall((r.text or "").translate(LOWER))
        sets[r.doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted((i, len(sets[i]), label[i]) for i in sets)


@pytest.mark.parametrize("crowd", [2, 16])
def test_near_duplicates(spark, monkeypatch, crowd):
    """Chains, stars and edited copies of several strengths, with crowded buckets and without."""
    monkeypatch.setattr(neardup, "CROWD", crowd)
    rng = random.Random(9)
    texts = [None, "", "one", "one", "One Two three four five"]
    for _ in range(6):
        words = prose(rng, 120, 3000).split()
        for rate in (0, 0, 0.01, 0.01, 0.02, 0.03, 0.04, 0.05, 0.06, 0.08, 0.15):
            texts.append(" ".join(f"e{rng.random()}" if rng.random() < rate else w for w in words))
    chain = prose(rng, 100, 3000).split()
    for i in range(12):  # each is linked to the next only
        texts.append(" ".join(chain))
        chain = [f"c{i}{j}" if j % 12 == i else w for j, w in enumerate(chain)]
    shared = prose(rng, 25, 3000)
    texts += [shared + " " + prose(rng, 60, 3000) for _ in range(30)]
    table = docs(spark, texts)
    for size in (4, 5):
        assert sorted(map(tuple, neardup.classes(table, size=size).collect())) == brute_components(table.collect(), size)
    kept = neardup.keep_one(table)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, c in brute_components(table.collect(), 5) if i == c]


def test_near_duplicates_awkward(spark, awkward):
    got = neardup.classes(awkward).collect()
    assert len(got) == awkward.count() and all(r.component_id is None for r in got if r.doc_id is None)
    assert {r.component_id for r in got if r.doc_id in (0, 1, 2, 13)} == {0}
    assert all(r.component_id == r.doc_id for r in got if r.doc_id in (3, 4, 5, 6, 8, 10, 15))
    assert neardup.classes(awkward.limit(0)).isEmpty()


def test_signature_distance_is_covered():
    """Signatures that differ in as many symbols as allowed share a key, wherever the differences are."""
    rng = np.random.default_rng(10)
    import pyarrow as pa

    for _ in range(300):
        a = rng.integers(0, 1 << 16, neardup.HASHES).astype(np.uint16)
        b = a.copy()
        b[rng.choice(neardup.HASHES, neardup.DISTANCE, replace=False)] ^= 1
        keys = [set(t.column("key").to_pylist()) for s in (a, b) for t in neardup._keys([pa.RecordBatch.from_arrays([pa.array([1]), pa.array([s.tobytes()])], names=["rep", "signature"])])]
        assert keys[0] & keys[1]


# 8 substring dedup


def brute_substring(rows, window=13):
    rows = [(r.doc_id, SPACED_RE.findall(r.text or "")) for r in rows]
    first = {}
    for i, w in rows:
        for j in range(len(w) - window + 1):
            g = tuple(w[j : j + window])
            first[g] = min(first.get(g, i), i)
    out = []
    for i, w in rows:
        gone = {k for j in range(len(w) - window + 1) if first[tuple(w[j : j + window])] < i for k in range(j, j + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [3, 2000])
def test_substring(spark, awkward, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT", hot)
    rng = random.Random(11)
    passage, line = prose(rng, 40, 3000), prose(rng, 14, 3000)
    texts = [prose(rng, rng.randrange(1, 60), 3000) + "\n" + (passage if i % 3 == 0 else line if i % 3 == 1 else "") + "  " + prose(rng, 20, 3000) for i in range(120)]
    texts += ["a b c " * 30, "a b c " * 20, texts[5], texts[5]]
    for table in (docs(spark, texts), awkward.filter("doc_id IS NOT NULL")):
        assert sorted(map(tuple, substring.digests(table).collect())) == brute_substring(table.collect())
    cut = {r.doc_id: r for r in substring.remove(docs(spark, texts)).collect()}
    want = {i: n - gone for i, n, gone, _ in brute_substring(docs(spark, texts).collect())}
    assert {i: len(r.text.split()) for i, r in cut.items()} == {i: n for i, n in want.items() if n}
    assert cut[0].text == texts[0] and all(r.n_chars == len(r.text) for r in cut.values())
    assert substring.remove(awkward).filter("doc_id IS NULL").count() == 2
    assert substring.digests(awkward.limit(0)).isEmpty() and substring.remove(awkward.limit(0)).isEmpty()


def test_substring_rows_are_small(spark, monkeypatch):
    rng = random.Random(13)
    texts, joined, blob, zipped = [prose(rng, 200, 3000) for _ in range(300)], [], substring._blob, substring.zipped
    ids, mini = np.arange(10), np.array([*range(9), 1 << 60], np.uint64)
    (key, hot, *rest), runs = substring._unblob(blob([b"a b"] * 10, mini, ids == 3, ids, -ids, ids * 7))
    assert key.tolist() == [*range(9), 0] and hot.tolist() == (ids == 3).tolist() and [c.tolist() for c in rest] == [ids.tolist(), (-ids).tolist(), (ids * 7).tolist()] and runs == [b"a b"] * 10
    run = substring.SuperKmers([t.encode() for t in texts], 13)
    packed = run.packed()
    size = len(blob(packed, run.mini, run.mini == 0, run.doc, rng_versions(rng, run.doc), run.at))
    assert size < len(zstandard.compress(b"\n".join(packed), 3)) + 14 * len(packed)
    monkeypatch.setattr(substring, "zipped", lambda df, text: joined.append(zipped(df, text)) or joined[-1])
    assert sorted(map(tuple, substring.digests(docs(spark, texts)).collect())) == brute_substring(docs(spark, texts).collect())
    assert sum(len(r.text) for r in joined[0].collect()) < sum(map(len, texts)) * 0.7


def rng_versions(rng, doc):
    of = [rng.getrandbits(62) for _ in range(int(doc.max()) + 1)]
    return np.array([of[d] for d in doc], np.int64)


def test_super_kmers_hold_every_window():
    rng = random.Random(12)
    texts = [prose(rng, n, 50).encode() for n in (5, 13, 200, 0, 40)]
    runs = substring.SuperKmers(texts, 13)
    got = sorted((int(d), int(a) + j, tuple(p.split()[j : j + 13])) for d, a, p in zip(runs.doc, runs.at, runs.packed(), strict=True) for j in range(len(p.split()) - 12))
    assert got == sorted((d, j, tuple(t.split()[j : j + 13])) for d, t in enumerate(texts) for j in range(len(t.split()) - 12))
    assert len(runs.mini) < len(got) / 2
    assert len(Words.of([b""], SPACED).start) == 0


# 9 fingerprints


def test_fingerprints(spark, awkward):
    rng = random.Random(13)
    texts = [prose(rng, rng.randrange(0, 80)) for _ in range(90)] + ["", None, "x", " ", "é" * 40, prose(rng, 20_000)]
    table = docs(spark, [(i * 3, t) for i, t in enumerate(texts)] + [(6, "tie")])
    rows = sorted((r.doc_id, r.text or "") for r in table.collect())
    want = []
    for n, (i, t) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(t) // 2
        changed = t[: len(t) - half] + after[:half]
        marks = [fingerprint.fingerprint(x.encode()) for x in (t, changed, after)]
        want.append((i, len(t), hashlib.sha256(changed.encode()).hexdigest(), fingerprint.shown(marks[0]), fingerprint.shown(marks[1]), fingerprint.likeness(marks[0], marks[1]), fingerprint.likeness(marks[0], marks[2])))
    for ranges in (1, 2, 7, 500):
        assert sorted(map(tuple, fingerprint.edited(table, ranges=ranges).collect())) == sorted(want)
    assert fingerprint.edited(awkward).count() == awkward.filter("doc_id IS NOT NULL").count() and fingerprint.edited(awkward.limit(0)).isEmpty()
    base = prose(rng, 300, 3000).split()
    near, shuffled = " ".join(base[:150] + ["new"] + base[151:]), " ".join(base[150:] + base[:150])
    a, b, c = (fingerprint.fingerprint(t.encode()) for t in (" ".join(base), near, shuffled))
    assert fingerprint.likeness(a, b) > 0.9 and fingerprint.likeness(a, c) < 0.75  # order matters, not only content


# 10 WARC


def test_warc(spark, tmp_path):
    rng = random.Random(14)
    bits = ["a", "é\r\n", warc.MAGIC, warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n", "x" * 50, "\r\n\r\n", "Content-Length: 9\r\n"]
    rows = [(i, f"http://x/{i}", "".join(rng.choice(bits) for _ in range(rng.randrange(30)))) for i in range(200)]
    rows += [(300 + i, None, rows[5][2]) for i in range(40)] + [(999, "u", None), (999, "u", None), (None, "u", "y" * 200), (1000, "u\r\nWARC-Type: x", "")]
    table = spark.createDataFrame([(*r, "extra", 1) for r in rows], "page_id long, url string, html string, digest string, first int")
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    want = []
    for i, _, t in rows:
        data = (t or "").encode()
        again = len(data) >= 100 and i is not None and first[t] < i
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[t] if again else None))
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size, compression in (("10000", "none"), ("128m", "none"), ("128m", "gzip")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            path = f"{tmp_path}/{size}-{compression}"
            warc.write(table.coalesce(2), path, compression=compression)
            assert sorted(map(str, map(tuple, warc.pages(spark, path).collect()))) == sorted(map(str, want))
            bodies = {bytes(r.payload) for r in warc.read(spark, path).collect() if "response" in r.header}
            assert bodies == {(t or "").encode() for _, _, t in rows}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    warc.write(table.limit(0), f"{tmp_path}/empty")
    assert warc.pages(spark, f"{tmp_path}/empty").isEmpty()


def test_warc_headers_of_any_length(spark, tmp_path):
    rows = [(0, "http://x/0", "a"), (1, "data:" + "é" * 40_000, "b" * 150), (2, "http://x/?" + "q" * (1 << 18), "c\r\n\r\nd"), (3, "http://x/3", "e"), (4, "u", "b" * 150)]
    for compression in ("none", "gzip"):
        path = f"{tmp_path}/{compression}"
        warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path, compression=compression)
        got = {r.page_id: tuple(r)[1:] for r in warc.pages(spark, path).collect()}
        assert got == {i: (len(t), hashlib.sha256(t.encode()).hexdigest(), "revisit" if i == 4 else "response", 1 if i == 4 else None) for i, _, t in rows}
        urls = {re.search("WARC-Target-URI: (.*)\r", r.header)[1] for r in warc.read(spark, path).collect()}
        assert urls == {u for _, u, _ in rows}


def test_warc_stretches_in_another_layout(spark, tmp_path):
    """Payloads with magic lines are whole where the archive is cut differently when it is read again."""
    inside = "x" * 700 + warc.MAGIC + "WARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(i, "u", f"{i} " + inside * (i % 4) + warc.MAGIC * (i % 3)) for i in range(40)]
    path = f"{tmp_path}/archive"
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
        found = warc.read(spark, path)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
        assert sorted(bytes(r.payload).decode() for r in found.collect()) == sorted(t for _, _, t in rows)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


# the pipeline


def test_pipeline_against_brute_force(spark, tmp_path):
    rng = random.Random(15)
    leak = prose(rng, 30, 3000)
    passage = prose(rng, 60, 3000)
    base = prose(rng, 120, 3000)
    texts = [prose(rng, 80, 3000) for _ in range(40)]
    texts += [base, base, " ".join(["first", *base.split(" ")[1:]]), prose(rng, 50, 3000) + " " + passage, prose(rng, 50, 3000) + " " + passage + " " + prose(rng, 9, 3000)]
    texts += ["you stupid idiot " + prose(rng, 60, 3000), prose(rng, 40, 3000) + " " + leak + " " + prose(rng, 40, 3000), leak, None, ""]
    table = docs(spark, texts)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found, held = table, {}
    for name, stage in corpus_pipeline.STAGES:
        before = found.collect()
        stage(spark, found, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        found = spark.read.parquet(f"{tmp_path}/{name}")
        held[name] = (before, found.collect())
        if name != "packing":
            assert found.columns == table.columns
    ids = lambda name: {r.doc_id for r in held[name][1]}
    assert {r.doc_id for r in held["toxicity"][0]} - ids("toxicity") == {45}
    assert ids("near_duplicates") == {i for i, _, c in brute_components(held["near_duplicates"][0], 5) if i == c}
    kept = {i: n - gone for i, n, gone, _ in brute_substring(held["substring_dedup"][0]) if n - gone or not n}
    assert {r.doc_id: len((r.text or "").split()) for r in held["substring_dedup"][1]} == kept
    clean = {r.doc_id: r.text for r in held["decontamination"][1]}
    assert 47 not in clean and leak not in clean[46] and clean[0] == texts[0] and clean[48] is None and clean[49] == ""
    whole = sorted(map(str, {r.doc_id for r in held["packing"][1]}))
    assert whole == sorted(map(str, clean))
    assert len(corpus_pipeline.run(spark, str(tmp_path)).collect()) == len(held["packing"][1])
