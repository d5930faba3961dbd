"""Benchmark decontamination: find every occurrence of a benchmark n-gram in the documents, and remove it.

The n-grams of the test items form a set that is sent to the tasks; each task rolls n-gram hashes over the words of
its documents, looks them up, and compares the words themselves for every hit. The benchmark reaches the driver in
blocks of at most ``BLOCK_BYTES``, each a broadcast of its own, so that no broadcast grows with the benchmark.

Defined results: a null text or one without words has no words, no hits and is clean; an item without words or
without an id has no window; repeated items count once by id; repeated documents are judged row by row; an empty
benchmark marks nothing; further columns are ignored by :func:`mark` and kept by :func:`remove`.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.words import ALNUM, Words, chunks, cut, kgrams, runs, utf8

WINDOW = 10
BLOCK_BYTES = 32 << 20

MARKS = "n_words long, n_hit long, item_ids array<string>, span_starts array<long>, span_ends array<long>"


class NgramSet:
    """The windows of some items: by length, sorted hashes to look up; by the words themselves, the item ids."""

    def __init__(self, items: Iterable[tuple], size: int):
        self.items: dict[bytes, set[str]] = {}
        by_length: dict[int, set[int]] = {}
        for item, text in items:
            words = Words.of([utf8(text)], ALNUM)
            n = len(words.start)
            if not n or item is None:
                continue
            k = min(size, n)
            for i, g in enumerate(kgrams(words.hashes(), k).tolist()):
                self.items.setdefault(words.text(i, i + k), set()).add(str(item))
                by_length.setdefault(k, set()).add(g)
        self.hashes = {k: np.array(sorted(v), np.uint64) for k, v in by_length.items()}

    def find(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[int, int, set[str]]]:
        """Start, end and items of each occurrence."""
        for k, known in self.hashes.items():
            grams = kgrams(hashes, k)
            at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
            for i in np.flatnonzero((known[at] == grams) & words.whole(k)).tolist():
                if (items := self.items.get(words.text(i, i + k))) is not None:
                    yield i, i + k, items


def blocks(benchmark: DataFrame, item: str, text: str, size: int) -> list:
    """The benchmark's windows as broadcasts of bounded size."""
    out, held, held_bytes = [], [], 0
    for row in benchmark.select(item, text).toLocalIterator():
        held.append((row[0], row[1]))
        held_bytes += size * len(utf8(row[1])) + 64
        if held_bytes >= BLOCK_BYTES:
            out.append(benchmark.sparkSession.sparkContext.broadcast(NgramSet(held, size)))
            held, held_bytes = [], 0
    if held:
        out.append(benchmark.sparkSession.sparkContext.broadcast(NgramSet(held, size)))
    return out


def _scan(texts: list[str | None], sets: list) -> Iterator[tuple[int, Words, list[bytes], np.ndarray, list[set[str]]]]:
    """For chunk after chunk: number of its first text, its words, its texts, the hit words, the items by document."""
    done = 0
    for part in chunks((t,) for t in texts):
        raw = [utf8(t) for (t,) in part]
        words = Words.of(raw, ALNUM)
        hashes = words.hashes()
        cover = np.zeros(len(words.start) + 1, np.int64)
        items: list[set[str]] = [set() for _ in raw]
        for ngrams in sets:
            for i, j, found in ngrams.value.find(words, hashes):
                cover[i] += 1
                cover[j] -= 1
                items[int(np.searchsorted(words.first, i, "right")) - 1] |= found
        yield done, words, raw, np.cumsum(cover[:-1]) > 0, items
        done += len(raw)


def mark(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW) -> DataFrame:
    """Per document: its id, ``n_words``, ``n_hit`` (words inside an occurrence of a window), the sorted ids of the
    items that occur, and the hit word spans (start inclusive, end exclusive)."""
    sets = blocks(benchmark, item, item_text, size)
    source = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *T._parse_datatype_string(MARKS).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for _, words, raw, hit, items in _scan(batch.column(1).to_pylist(), sets):
                for d in range(len(raw)):
                    lo, hi = words.first[d], words.first[d + 1]
                    starts, ends = runs(hit[lo:hi])
                    rows.append((int(hi - lo), int((ends - starts).sum()), sorted(items[d]), starts.tolist(), ends.tolist()))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.int64())]
            columns = [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=[f.name for f in schema])

    return source.mapInArrow(run, schema)


def remove(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", size: int = WINDOW, whole_documents: bool = False) -> DataFrame:
    """The documents, all columns, without the hit spans; ``n_chars`` follows where there is such a column. Documents
    of which nothing but hits was there go; with ``whole_documents`` every document with a hit goes. Documents
    without hits stay as they are."""
    sets = blocks(benchmark, item, item_text, size)
    schema, at = docs.schema, docs.columns.index(text)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, keep = batch.column(at).to_pylist(), np.ones(batch.num_rows, bool)
            changed = False
            for done, words, raw, hit, _ in _scan(texts, sets):
                base = 0
                for d, data in enumerate(raw):
                    own = hit[words.first[d] : words.first[d + 1]]
                    if own.any():
                        changed = True
                        keep[done + d] = not (whole_documents or own.all())
                        texts[done + d] = cut(data, words, d, base, own).decode("utf-8")
                    base += len(data) + 1
            if changed:
                columns = list(batch.columns)
                columns[at] = pa.array(texts, batch.schema.field(at).type)
                if counted is not None:
                    kind = batch.schema.field(counted).type
                    columns[counted] = pa.array([n if t is None else len(t) for n, t in zip(batch.column(counted).to_pylist(), texts, strict=True)]).cast(kind)
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema).filter(pa.array(keep))
            yield batch

    return docs.mapInArrow(run, schema)
