"""Toxicity by a weighted finite-state pattern grammar over clauses.

Words become symbols by a lexicon: insult, threat, target, negation, report verb, a word of a phrase, or other. Five
transducers, for insults and threats of several words, negation, reported speech and targets, and a weighing machine are
composed into one sequential machine; it reads the symbols of a clause and pays out a weight for every match in its
context, so a negated or quoted insult counts for less and an insult or a threat next to a target for more. A document's evidence is the sum over its clauses, its
score ``1 - exp(-evidence)``. Clauses that would not reject a document alone count relative to its length, so that
unrelated words far apart in a long text don't add up.

The grammar is fixed. The lexicon has a small fixed part and a learned part: words and word beginnings that occur in
toxic training documents, between many different neighbours (so copies of one document are no evidence), and hardly
in the others: the share of toxic documents with an entry is held against that of the others, with a confidence bound,
so an entry's chance doesn't depend on the size of the table. Learning is a grouped count over all training documents;
the model keeps every entry that passes.

Defined results: a null or empty text scores 0; repeated rows score alike; without labels only the fixed part is
used; further columns are ignored by :func:`score` and kept by :func:`reject`.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.words import ALNUM, chunks
from fleetmart.operators.settle import settle

THRESHOLD = 0.3
NEIGHBOURS = 4  # different words before, and after, that a learned entry must have in toxic documents
DOCUMENTS = 4  # different toxic documents that must hold a learned entry
STEMS = (4, 5)
ALONE = -math.log(1 - THRESHOLD)  # evidence that rejects a document
SPAN = 200  # words over which clauses of less evidence than that count in full
MIN_LOG_ODDS = 3.5
DEVIATIONS = 2.0  # standard errors off the log odds, and what must then be left of them
MIN_BOUND = 1.0

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT = range(6)

FIXED = {
    INSULT: "idiot idiots moron morons stupid dumb scum trash clown loser losers pathetic worthless disgusting imbecile scumbag bastard",
    THREAT: "kill hurt destroy stab shoot strangle burn beat crush smash murder",
    TARGET: "you your yours yourself u ur they them their he him she her these those people tu toi vous ton votre du dich ihr euch dein usted tus",
    NEGATION: "not never no isn aren wasn nobody none without pas jamais nicht kein keine nie niemals nunca jamás",
    REPORT: "said says called claimed wrote quoted quote alleged reportedly dit écrit sagte schrieb behauptete dijo escribió",
}

FIXED_WORDS = frozenset(w for listed in FIXED.values() for w in listed.split())

#: insults and threats of several words; TARGET stands for any target word
PHRASES = {
    INSULT: ["waste of space", "piece of garbage", "piece of work", "shut up", "good for nothing", "go to hell", "sack of shit", "make me sick", "brain dead"],
    THREAT: ["make TARGET pay", "make TARGET suffer", "TARGET will regret", "TARGET will pay for", "come for TARGET", "coming for TARGET", "end TARGET life", "watch TARGET back", "know where TARGET live", "teach TARGET a lesson"],
}

# the grammar ----------------------------------------------------------------------------------------------------

#: symbols that pass between the machines, above the six of the lexicon
SOFT_INSULT, SOFT_THREAT, TOLD_INSULT, TOLD_THREAT, AIMED_INSULT, AIMED_THREAT, MEANT_THREAT = range(6, 13)

#: symbols of the words that phrases are made of. A word with a meaning of its own has one symbol for each, which carries it on
_OWN = {w: s for s, listed in FIXED.items() for w in listed.split()}
PHRASE_WORDS = {w: 13 + n for n, w in enumerate(sorted({w for listed in PHRASES.values() for p in listed for w in p.split()} - {"TARGET"}))}
BASE = {s: _OWN.get(w, OTHER) for w, s in PHRASE_WORDS.items()}
SYMBOLS = 13 + len(PHRASE_WORDS)


@dataclass(frozen=True)
class Machine:
    """A sequential transducer: from (state, symbol) to (state, symbol, weight); state 0 begins every clause."""

    step: dict[tuple[int, int], tuple[int, int, float]]


def machine(states: int, rule) -> Machine:
    return Machine({(q, s): rule(q, s) for q in range(states) for s in range(SYMBOLS)})


def compose(first: Machine, second: Machine) -> Machine:
    """The second reads what the first writes; weights multiply. Only reachable pairs of states are kept."""
    number, todo, step = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for s in range(SYMBOLS):
            a, between, wa = first.step[pair[0], s]
            b, out, wb = second.step[pair[1], between]
            if (a, b) not in number:
                number[a, b] = len(number)
                todo.append((a, b))
            step[number[pair], s] = (number[a, b], out, wa * wb)
    return Machine(step)


def phrases(kind: int, listed: list[str], pass_on: bool) -> Machine:
    """Reads words of phrases and writes ``kind`` at the end of a phrase, the longest beginning of a phrase that ends here
    being the state. What completes none is written as it was read, or with the word's own meaning."""
    spelled = [tuple(TARGET if w == "TARGET" else PHRASE_WORDS[w] for w in p.split()) for p in listed]
    begun = sorted({p[:n] for p in spelled for n in range(len(p) + 1)}, key=lambda b: (len(b), b))
    number = {b: q for q, b in enumerate(begun)}

    def rule(q: int, s: int) -> tuple[int, int, float]:
        read = (*begun[q], s)
        done = any(read[n:] in spelled for n in range(len(read)))
        after = next(number[read[n:]] for n in range(len(read) + 1) if read[n:] in number)
        return after, kind if done else s if pass_on else BASE.get(s, s), 1.0

    return machine(len(begun), rule)


def _negation(q: int, s: int) -> tuple[int, int, float]:
    """Three symbols after a negation, insults and threats are soft."""
    soft = {INSULT: SOFT_INSULT, THREAT: SOFT_THREAT, MEANT_THREAT: SOFT_THREAT}.get(s, s) if q else s
    return (3 if s == NEGATION else max(0, q - 1)), soft, 1.0


def _report(q: int, s: int) -> tuple[int, int, float]:
    """From a report verb to the end of the clause, insults and threats are told."""
    told = {INSULT: TOLD_INSULT, THREAT: TOLD_THREAT, MEANT_THREAT: TOLD_THREAT}.get(s, s) if q else s
    return (1 if q or s == REPORT else 0), told, 1.0


def _target(q: int, s: int) -> tuple[int, int, float]:
    """States 1 to 5: a target so many symbols ahead of now runs out; 6 to 8: an insult, 9 to 11: a threat waits for
    one. A threat is aimed at what follows it only, a phrase at the target that it names."""
    if s == MEANT_THREAT:
        return max(0, q - 1) if q not in (6, 9) else 0, AIMED_THREAT, 1.0
    if s == TARGET:
        return 5, (AIMED_THREAT if q >= 9 else AIMED_INSULT if q >= 6 else s), (0.5 if 6 <= q <= 8 else 1.0)
    if s == INSULT:
        return 8, (AIMED_INSULT if 1 <= q <= 5 else s), 1.0
    if s == THREAT:
        return 11, s, 1.0
    return {0: 0, 1: 0, 6: 0, 9: 0}.get(q, q - 1), s, 1.0


PAYS = {INSULT: 1.0, THREAT: 0.15, SOFT_INSULT: 0.25, SOFT_THREAT: 0.0, TOLD_INSULT: 0.3, TOLD_THREAT: 0.05, AIMED_INSULT: 1.5, AIMED_THREAT: 1.2}


def _pay(q: int, s: int) -> tuple[int, int, float]:
    return 0, s, PAYS.get(s, 0.0)


GRAMMAR = phrases(INSULT, PHRASES[INSULT], True)
for _machine in (phrases(MEANT_THREAT, PHRASES[THREAT], False), machine(4, _negation), machine(2, _report), machine(12, _target), machine(1, _pay)):
    GRAMMAR = compose(GRAMMAR, _machine)


def clause_weight(symbols: list[tuple[int, float]]) -> float:
    """What the grammar pays for a clause, given as (symbol, weight of the word)."""
    state, total = 0, 0.0
    for s, w in symbols:
        state, _, pays = GRAMMAR.step[state, s]
        total += pays * w
    return total


# scoring --------------------------------------------------------------------------------------------------------

_CLAUSE_ENDS = re.compile(r"[.!?;:,\n\r()\"“”«»|]")


@dataclass(frozen=True)
class Lexicon:
    """Words and word beginnings with their symbol and weight."""

    words: dict[str, tuple[int, float]]
    stems: dict[str, float]

    def symbol(self, word: str) -> tuple[int, float]:
        found = self.words.get(word)
        if word in PHRASE_WORDS and (found is None or found == (BASE[PHRASE_WORDS[word]], 1.0)):
            return PHRASE_WORDS[word], 1.0
        if found is None:
            found = max(((INSULT, self.stems[word[:n]]) for n in STEMS if len(word) > n and word[:n] in self.stems), default=(OTHER, 0.0))
            if found[0] == OTHER:
                return found
        return found


def words_of(clause: str) -> list[str]:
    return clause.encode("utf-8", "replace").translate(ALNUM).decode("utf-8", "replace").split(" ")


def evidence(text: str, lexicon: Lexicon, cache: dict[str, tuple[int, float]]) -> float:
    """Clauses are taken apart only where a document holds an insult or a threat at all."""
    mine = {}
    words = words_of(text)
    for w in set(words):
        if w and (found := cache.get(w) or cache.setdefault(w, lexicon.symbol(w)))[0] != OTHER:
            mine[w] = found
    if not any(s in (INSULT, THREAT) or s > MEANT_THREAT for s, _ in mine.values()):
        return 0.0
    none = (OTHER, 0.0)
    paid = [clause_weight([mine.get(w, none) for w in words_of(clause) if w]) for clause in _CLAUSE_ENDS.split(text)]
    strong = sum(p for p in paid if p >= ALONE)
    weak = sum(p for p in paid if p < ALONE)
    return strong + (weak * min(1.0, SPAN / sum(map(bool, words))) if weak else 0.0)


def score(docs: DataFrame, lexicon: Lexicon, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id and ``score`` between 0 and 1."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, float]] = {}
        for batch in batches:
            scores = []
            for t in batch.column(1):
                if len(cache) > 200_000:
                    cache.clear()
                t = t.as_py()
                scores.append(1 - math.exp(-evidence(t, shared.value, cache)) if t else 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


def reject(docs: DataFrame, lexicon: Lexicon, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents, all columns, whose score is below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, tuple[int, float]] = {}
        for batch in batches:
            if len(cache) > 200_000:
                cache.clear()
            keep = [not t or 1 - math.exp(-evidence(t, shared.value, cache)) < threshold for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


# learning -------------------------------------------------------------------------------------------------------

COUNTS = "entry string, before int, after int, toxic long, clean long"


def _entries(word: str) -> list[str]:
    """Fixed words speak for themselves, not for other words that begin like them."""
    return [word] if word in FIXED_WORDS else [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (text, label): for toxic texts a row for each entry and neighbourhood, one of which counts the text for the
    entry; for the others a count of documents by entry, summed up before it leaves the task."""
    import zlib

    kinds = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        for part in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), limit=1 << 22):
            clean: Counter = Counter()
            rows: list[tuple] = []
            documents = [0, 0]
            for text, toxic in part:
                words = [w for w in words_of(text or "") if w]
                documents[bool(toxic)] += 1
                if not toxic:
                    clean.update({e for w in set(words) for e in _entries(w)})
                    continue
                marks = [zlib.crc32(w.encode()) - (1 << 31) for w in ["", *words, ""]]
                own = {(e, marks[i], marks[i + 2]) for i, w in enumerate(words) for e in _entries(w)}
                counted: set[str] = set()
                for e, before, after in own:
                    rows.append((e, before, after, int(e not in counted), 0))
                    counted.add(e)
            out = [*rows, *((e, None, None, 0, n) for e, n in clean.items()), ("", None, None, documents[1], documents[0])]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], kind) for c, kind in enumerate(kinds)], names=["entry", "before", "after", "toxic", "clean"])


def learn(labelled: DataFrame, text: str = "text", label: str = "toxic") -> Lexicon:
    """The lexicon for documents with labels; rows without a label are ignored. Every labelled text is counted, toxic
    ones of the same text once."""
    rows = labelled.filter(F.col(label).isNotNull()).select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label"))
    # toxic texts are made distinct before anything is counted, so one exchange by entry is enough
    rows = rows.filter("label = 0").union(rows.filter("label <> 0").distinct())
    # neighbours are counted by small sketches: an entry's state has one size however common it is
    counted = settle(
        rows.mapInArrow(_count, COUNTS).groupBy("entry").agg(
            F.approx_count_distinct("before", 0.2).alias("before"), F.approx_count_distinct("after", 0.2).alias("after"),
            F.sum("toxic").alias("n_toxic"), F.sum("clean").alias("n_clean"),
        ).filter(((F.least("before", "after") >= NEIGHBOURS) & (F.col("n_toxic") >= DOCUMENTS)) | (F.col("entry") == ""))
    )
    total = counted.filter("entry = ''").select("n_toxic", "n_clean").first()
    n_toxic, n_clean = (total[0], total[1]) if total else (0, 0)
    odds = F.log((F.col("n_toxic") + 0.5) / F.lit(n_toxic + 1.0)) - F.log((F.col("n_clean") + 0.5) / F.lit(n_clean + 1.0))
    error = F.sqrt(1 / (F.col("n_toxic") + 0.5) + 1 / (F.col("n_clean") + 0.5))
    chosen = (
        counted.filter(F.col("entry") != "")
        .withColumns({"odds": odds, "bound": odds - DEVIATIONS * error})
        .filter((F.col("odds") >= MIN_LOG_ODDS) & (F.col("bound") >= MIN_BOUND))
        .collect()
    )
    words = {w: (s, 1.0) for s, listed in FIXED.items() for w in listed.split()}
    stems: dict[str, float] = {}
    for r in chosen:
        weight = min(1.0, r["odds"] / 6) * r["n_toxic"] / (r["n_toxic"] + 8.0)
        if r["entry"].endswith("*"):
            stems[r["entry"][:-1]] = weight
        elif words.get(r["entry"], (INSULT,))[0] == INSULT:
            words[r["entry"]] = (INSULT, max(weight, words.get(r["entry"], (INSULT, 0.0))[1]))
    return Lexicon(words, stems)
