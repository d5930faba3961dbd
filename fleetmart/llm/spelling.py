"""Spelling variants by finite-state composition.

The words of a corpus that differ by one inserted, deleted or replaced code point are the pairs that the composition
A . T . A accepts: A is the minimised acceptor of the vocabulary, T a transducer that copies, makes one edit and copies
on. The composition is enumerated for each state that a part of a word leads to:

* An edit lies in the first or in the second half of the shorter word, so both words of a pair agree in the other half.
  That half, read forwards or backwards, leads to one state, and the words that pass it are a partition: context left
  and right, and between them the ``mid`` that the edit lies in. Where a partition is too large for a task, its mid
  is halved again, until it fits or the edit has a single place left, which an alphabet bounds.
* In a partition the mids are minimised into one acceptor, sorted word by word. Pairs of states are walked together: before the
  edit along equal arcs, at the edit along different ones (replacement) or on one side only (insertion), after
  it along equal arcs again, and where both sides have reached the same state, all its words are accepted. An insertion
  counts at its last possible place, so every pair has one path in one partition.

A word's form is its near word of the largest count, if that is at least RATIO times its own; forms are followed by pointer
jumping; counts grow along a chain, so it has no circle and a few steps.

Defined results: a null text has no words; a null identifier counts as an empty one; of near words with equal counts
the smallest in code-point order is the form; a word of any length is taken whole; an empty table gives an empty table;
further columns don't matter.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetmart.operators.settle import settle

LEAST = 7
TWICE = 2
RATIO = 10
NOISE = 31
HELD = 1 << 17  # distinct words that a task counts before it passes them on
PARTITION = 20_000

_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}


# vocabulary -------------------------------------------------------------------------------------------------------


def spelled(id: object, run: str, noise: int = NOISE) -> str:
    """The run as it stands in the corpus under test: where ``noise`` divides the CRC of ``id:run``, without one of its code points."""
    h = zlib.crc32(f"{'' if id is None else id}:{run}".encode())
    if h % noise:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, noise: int | None = NOISE) -> DataFrame:
    """(word, n): the distinct runs of Latin letters, A-Z in lower case, with at least ``least`` code points and two occurrences;
    ``noise`` None takes them as they are."""
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{least},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        flushed = lambda: pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
        for batch in batches:
            for key, t in zip(batch.column(0), batch.column(1), strict=True):
                key, own = key.as_py(), Counter(runs.findall((t.as_py() or "").translate(_LOWER)))
                for word, n in own.items():
                    if noise:
                        word = spelled(key, word, noise)
                        if len(word) < least:
                            continue
                    held[word] += n
                if len(held) >= HELD:
                    yield flushed()
                    held.clear()
        if held:
            yield flushed()

    return docs.select(id, text).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= TWICE)


# partitions -------------------------------------------------------------------------------------------------------

#: a partition holds words that may be the shorter one of a pair (longer 0, of ``size`` code points) and the longer one
#: (longer 1); the edit has its place in lo ... hi - 1 of the shorter one
_PART = "size int, lo int, hi int, left string, right string, longer int, mid string, n long"
_KEY = ["size", "lo", "hi", "left", "right"]


def _halves(size, lo, hi, left, right, longer, mid, n) -> list:
    """A partition's row in the partitions of the two halves of its places."""
    at = F.floor((lo + hi) / 2).cast("int")
    kept = at - lo
    cut = kept + longer
    row = lambda lo, hi, left, right, mid: F.struct(*(c.alias(f.split()[0]) for c, f in zip((size, lo, hi, left, right, longer, mid, n), _PART.split(", "), strict=True)))
    return [
        row(lo, at, left, F.concat(F.substring(mid, cut + 1, F.length(mid)), right), F.substring(mid, F.lit(1), cut)),
        row(at, hi, F.concat(left, F.substring(mid, F.lit(1), kept)), right, F.substring(mid, kept + 1, F.length(mid))),
    ]


def partitions(words: DataFrame, least: int = LEAST, limit: int = PARTITION) -> DataFrame:
    """Every word in the partitions of its halves, as the shorter and as the longer one of a pair; partitions of more than ``limit``
    rows in halves again."""
    none, first = F.lit(""), F.lit(0).cast("int")
    size = F.length("word").cast("int")
    rows = [r for longer in (0, 1) for r in _halves(size - longer, first, size - longer + 1, none, none, F.lit(longer).cast("int"), F.col("word"), F.col("n"))]
    parts = words.select(F.explode(F.array(*rows)).alias("p")).select("p.*").filter(F.col("size") >= least)
    while True:
        counts = parts.filter("hi - lo > 1").groupBy(*_KEY).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > limit).drop("rows")
        hot = settle(counts)
        if hot.isEmpty():
            return parts
        mark = hot.withColumn("hot", F.lit(True))
        columns = [F.col(f.split()[0]) for f in _PART.split(", ")]
        marked = parts.hint("merge").join(mark.hint("merge"), _KEY, "left")
        cooler = marked.filter("hot").select(F.explode(F.array(*_halves(*columns))).alias("p")).select("p.*")
        parts = settle(marked.filter("hot IS NULL").select(*columns).union(cooler.select(*columns)))


# automata ---------------------------------------------------------------------------------------------------------


class Acceptor:
    """Minimal acyclic acceptors that share their states: equal states accept equal words."""

    def __init__(self) -> None:
        self.arcs: list[dict[str, int]] = []
        self.final: list[bool] = []
        self.known: dict[tuple, int] = {}
        self.words: dict[int, list[str]] = {}

    def _state(self, final: bool, arcs: dict[str, int]) -> int:
        key = (final, *arcs.items())
        if (state := self.known.get(key)) is None:
            state = self.known[key] = len(self.arcs)
            self.arcs.append(arcs)
            self.final.append(final)
        return state

    def of(self, words: list[str]) -> int:
        """The first state of the acceptor of sorted, distinct words."""
        path: list[list] = [[False, {}]]  # states that may still grow: [final, arcs]
        last = ""
        for word in words:
            same = 0
            for x, y in zip(word, last):  # noqa: B905 - the shorter one ends it
                if x != y:
                    break
                same += 1
            self._close(path, last, same)
            for _ in range(same, len(word)):
                path.append([False, {}])
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        return self._state(*path[0])

    def _close(self, path: list[list], last: str, keep: int) -> None:
        while len(path) > keep + 1:
            done = self._state(*path.pop())
            path[-1][1][last[len(path) - 1]] = done

    def language(self, state: int) -> list[str]:
        """All words that a state accepts."""
        if state not in self.words:
            found, todo = [], [(state, "")]
            while todo:
                q, so_far = todo.pop()
                if self.final[q]:
                    found.append(so_far)
                todo.extend((t, so_far + c) for c, t in self.arcs[q].items())
            self.words[state] = found
        return self.words[state]

    def common(self, a: int, b: int) -> Iterator[str]:
        """The words that two states accept."""
        todo = [(a, b, "")]
        while todo:
            p, q, so_far = todo.pop()
            if p == q:
                yield from (so_far + w for w in self.language(p))
                continue
            if self.final[p] and self.final[q]:
                yield so_far
            others = self.arcs[q]
            todo.extend((t, others[c], so_far + c) for c, t in self.arcs[p].items() if c in others)

    def replaced(self, start: int) -> Iterator[tuple[str, str]]:
        """Pairs of accepted words that differ by one replacement."""
        todo = [(start, "")]
        while todo:
            q, so_far = todo.pop()
            arcs = list(self.arcs[q].items())
            for i, (c, s) in enumerate(arcs):
                for d, t in arcs[:i]:
                    for rest in self.common(s, t):
                        yield so_far + c + rest, so_far + d + rest
                todo.append((s, so_far + c))

    def inserted(self, short: int, long: int, places: int) -> Iterator[tuple[str, str]]:
        """Pairs of a word of ``short`` and a word of ``long`` that has one code point more, at one of the first ``places`` places."""
        todo = [(short, long, "")]
        while todo:
            p, q, so_far = todo.pop()
            if len(so_far) >= places:
                continue
            own = self.arcs[p]
            for c, t in self.arcs[q].items():
                for rest in self.common(p, t):
                    if not rest.startswith(c):
                        yield so_far + rest, so_far + c + rest
                if c in own:
                    todo.append((own[c], t, so_far + c))


def pairs(shorter: list[str], longer: list[str], places: int) -> Iterator[tuple[int, str, int, str]]:
    """(0, word, 0 or 1, word) of the near pairs of a partition's mids; 1 marks a longer one."""
    acceptor = Acceptor()
    start = acceptor.of(sorted(shorter))
    for u, v in acceptor.replaced(start):
        yield 0, u, 0, v
    if longer:
        for u, v in acceptor.inserted(start, acceptor.of(sorted(longer)), places):
            yield 0, u, 1, v


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows of whole partitions, sorted: for each word its number of near words there and the best of them."""
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])
    out: dict[str, list] = {k: [] for k in schema.names}

    def group(key: tuple, held: tuple[dict[str, int], dict[str, int]]) -> None:
        if not held[0] or len(held[0]) + len(held[1]) < 2:
            return
        near: dict[tuple[int, str], list] = {}
        for i, u, j, v in pairs(list(held[0]), list(held[1]), key[2] - key[1]):
            near.setdefault((i, u), []).append((-held[j][v], v))
            near.setdefault((j, v), []).append((-held[i][u], u))
        for (_, word), others in near.items():
            n, best = min((n, f"{key[3]}{other}{key[4]}") for n, other in others)
            for name, value in zip(schema.names, (f"{key[3]}{word}{key[4]}", len(others), -n, best), strict=True):
                out[name].append(value)

    key, held = None, ({}, {})
    for batch in batches:
        for *own, longer, mid, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                if key:
                    group(key, held)
                key, held = own, ({}, {})
            held[longer][mid] = n
        if len(out["word"]) > 10_000:
            yield pa.RecordBatch.from_pydict(out, schema=schema)
            out = {k: [] for k in schema.names}
    if key:
        group(key, held)
    yield pa.RecordBatch.from_pydict(out, schema=schema)


# the operator -----------------------------------------------------------------------------------------------------


def near(words: DataFrame, least: int = LEAST, limit: int = PARTITION) -> DataFrame:
    """(word, n_near, best_n, best) of the words (word, n) that have near words."""
    parts = partitions(words, least, limit).repartition(*_KEY).sortWithinPartitions(*_KEY)
    found = parts.select(*(f.split()[0] for f in _PART.split(", "))).mapInArrow(_near, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word"))).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select("word", "n_near", (-F.col("best.n")).alias("best_n"), F.col("best.word").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the end of each chain, by pointer jumping."""
    now = settle(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = settle(now.hint("merge").join(onward.hint("merge"), "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def variants(words: DataFrame, least: int = LEAST, ratio: int = RATIO, limit: int = PARTITION) -> DataFrame:
    """Per word of (word, n): ``form``, ``root``, ``n``, ``n_near``, ``form_n``."""
    words = settle(words)
    found = words.hint("merge").join(near(words, least, limit).hint("merge"), "word", "left")
    far = F.col("best_n") >= ratio * F.col("n")
    found = settle(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best")).alias("form"), F.when(far, F.col("best_n")).alias("form_n")))
    ends = roots(found.filter("form IS NOT NULL"))
    return found.hint("merge").join(ends.hint("merge"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
