"""Substring dedup: words covered by a window that also starts in a document with a smaller id are removed.

Super-k-mer partitioning. The minimiser of a window is the smallest hash of its ``MINI`` consecutive words. Runs of
windows with the same minimiser travel as one packed string to the bucket of that minimiser; equal windows have equal
minimisers, so they meet there. The super-k-mers that a task has for a bucket go in one compressed row. In the
bucket they are sorted by minimiser, document and position; of a minimiser with several documents the windows are
compared by their words, and every occurrence after the smallest document is marked. A row holds three bytes of each
minimiser: they only bring together what is then compared by its words. Texts that meet their marks travel compressed.

A minimiser inside a passage that very many documents share would make its bucket large. Such minimisers are counted
first and their super-k-mers spread over several buckets by document. A bucket then marks what has a smaller document
in the same bucket, and passes on the smallest document of every window; these few rows are compared across buckets.
The list of spread minimisers holds the ``SPREAD`` most frequent ones at most, which bounds the broadcast; it decides
only where rows go, never what is compared.

Defined results: ids are numbers; null texts and texts of fewer words than a window lose nothing; windows are judged on the input;
repeated rows of one id don't remove each other (no smaller id); rows without an id lose nothing and remove nothing;
an empty table gives an empty table; further columns are kept and none of their names clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.words import SPACED, Words, chunks, cut, kgrams, mix, sliding_min, unzipped, utf8, zipped
from fleetmart.operators.settle import settle

WINDOW = 13
MINI = 3
BUCKET_BYTES = 8 << 20
CHUNK_BYTES = 4 << 20
HOT = 2000
SPREAD = 1 << 18

_U = np.uint64


class SuperKmers:
    """The super-k-mers of a chunk of texts: run i has the windows from word ``first[i]`` to ``last[i]``, the
    minimiser ``mini[i]``, and belongs to text ``doc[i]``."""

    def __init__(self, texts: list[bytes], window: int):
        words = Words.of(texts, SPACED)
        mini = sliding_min(kgrams(words.hashes(), MINI), window - MINI + 1)
        valid = np.flatnonzero(words.whole(window))
        chosen, doc = mini[valid], words.document()[valid]
        new = np.ones(len(valid), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(valid))[: len(starts)]
        self.first, self.last = valid[starts], valid[ends - 1]
        self.mini, self.doc = chosen[starts], doc[starts]
        self.at = self.first - words.first[self.doc]
        self.words, self.window = words, window

    def packed(self) -> list[bytes]:
        """The words of each run, with one space between them."""
        text = b" ".join(self.words.data.split())
        ends = np.cumsum(self.words.end - self.words.start + 1) - 1
        starts = ends - (self.words.end - self.words.start)
        return [text[s:e] for s, e in zip(starts[self.first].tolist(), ends[self.last + self.window - 1].tolist(), strict=True)]


def _frequent(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """The minimisers that a chunk has at least eight times, and how often; under key 0, the text bytes."""
    for batch in batches:
        for part in chunks(((t,) for t in batch.column(0).to_pylist()), limit=CHUNK_BYTES):
            raw = [utf8(t) for (t,) in part]
            minis, counts = np.unique(SuperKmers(raw, window).mini, return_counts=True)
            often = counts >= 8
            keys = np.append(minis[often], _U(0)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.append(counts[often], sum(map(len, raw))))], names=["mini", "n"])


class Spread:
    """For frequent minimisers, over how many shards their documents go."""

    def __init__(self, minis: list[int], counts: list[int]):
        order = np.argsort(np.array(minis, np.int64).view(_U))
        self.minis = np.array(minis, np.int64).view(_U)[order]
        self.shards = np.array([-(-n // HOT) for n in counts], np.int64)[order]

    def of(self, mini: np.ndarray) -> np.ndarray:
        if not len(self.minis):
            return np.ones(len(mini), np.int64)
        at = np.minimum(np.searchsorted(self.minis, mini), len(self.minis) - 1)
        return np.where(self.minis[at] == mini, self.shards[at], 1)


def _blob(runs: list[bytes], mini: np.ndarray, hot: np.ndarray, ids: np.ndarray, versions: np.ndarray, at: np.ndarray) -> bytes:
    """Numbers and words in frames of their own: each compresses better without the other."""
    key = np.ascontiguousarray((mini & _U(0xFFFFFF)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3])
    numbers = b"".join([key.tobytes(), np.packbits(hot).tobytes(), *(c.astype(np.int64).tobytes() for c in (ids, versions, at))])
    zstd = zstandard.ZstdCompressor(level=3)
    frames = [zstd.compress(numbers), zstd.compress(b"\n".join(runs))]
    return b"".join([len(runs).to_bytes(8, "little"), len(frames[0]).to_bytes(8, "little"), *frames])


def _unblob(blob: bytes) -> tuple[list[np.ndarray], list[bytes]]:
    """Three bytes of the minimisers, whether they are spread, ids, versions, positions; the words."""
    n, size = (int.from_bytes(blob[i : i + 8], "little") for i in (0, 8))
    zstd = zstandard.ZstdDecompressor()
    numbers, words = zstd.decompress(blob[16 : 16 + size]), zstd.decompress(blob[16 + size :])
    key = np.zeros((n, 4), np.uint8)
    key[:, :3] = np.frombuffer(numbers, np.uint8, 3 * n).reshape(n, 3)
    bits = -(-n // 8)
    hot = np.unpackbits(np.frombuffer(numbers, np.uint8, bits, 3 * n), count=n).astype(bool)
    rest = np.frombuffer(numbers, np.int64, 3 * n, 3 * n + bits).reshape(3, n)
    return [key.view("<u4").ravel(), hot, *rest], words.split(b"\n")


def _sent(batches: Iterator[pa.RecordBatch], window: int, spread, buckets: int) -> Iterator[pa.RecordBatch]:
    """From (id, version, text): for each chunk and bucket a row with its super-k-mers."""
    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in (2, 0, 1)), strict=True)
        for part in chunks((r for r in rows if r[1] is not None), limit=CHUNK_BYTES):
            runs = SuperKmers([utf8(r[0]) for r in part], window)
            if not len(runs.mini):
                continue
            ids, versions = np.array([r[1] for r in part], np.int64), np.array([r[2] for r in part], np.int64)
            shards = spread.value.of(runs.mini)
            shard = mix(ids[runs.doc].view(_U)) % shards.astype(_U)
            bucket = (mix(runs.mini + shard * _U(0x9E3779B97F4A7C15)) % _U(buckets)).astype(np.int64)
            order, packed = np.argsort(bucket, kind="stable"), runs.packed()
            edges = np.flatnonzero(np.diff(bucket[order], prepend=-1, append=-1))
            blobs = []
            for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                own = order[lo:hi]
                blobs.append(_blob([packed[i] for i in own.tolist()], runs.mini[own], shards[own] > 1, ids[runs.doc[own]], versions[runs.doc[own]], runs.at[own]))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[order[edges[:-1]]]), pa.array(blobs, pa.binary())], names=["bucket", "runs"])


FOUND = "id long, version long, start long, n long, w_a long, w_b long"


def _compared(blobs: list[bytes], window: int) -> Iterator[tuple]:
    """Marks (id, version, first window, windows, null, null); for spread minimisers also the smallest document's
    occurrences of each window, with a 128-bit digest of the window in place of the nulls."""
    parts = [_unblob(b) for b in blobs]
    mini, spread, ids, versions, at = (np.concatenate([p[0][c] for p in parts]) for c in range(5))
    texts = [t for p in parts for t in p[1]]
    order = np.lexsort((at, versions, ids, mini))
    edges = np.flatnonzero(np.diff(mini[order], prepend=mini[order[0]] ^ 1, append=mini[order[-1]] ^ 1))
    lo, hi = edges[:-1], edges[1:]
    hot = np.logical_or.reduceat(spread[order], lo)
    several = (ids[order[lo]] != ids[order[hi - 1]]) | hot
    for s, e, passes in zip(lo[several].tolist(), hi[several].tolist(), hot[several].tolist(), strict=True):
        smallest: dict[bytes, int] = {}
        for i in order[s:e].tolist():  # by document, so the first to show a window is the smallest
            text, id, version, start = texts[i], int(ids[i]), int(versions[i]), int(at[i])
            offsets = [0]
            for w in text.split(b" "):
                offsets.append(offsets[-1] + len(w) + 1)
            run = 0
            n = len(offsets) - window
            for j in range(n):
                key = text[offsets[j] : offsets[j + window] - 1]
                later = smallest.setdefault(key, id) < id
                if later:
                    run += 1
                elif run:
                    yield id, version, start + j - run, run, None, None
                    run = 0
                if passes and not later:
                    digest = hashlib.blake2b(key, digest_size=16).digest()
                    yield id, version, start + j, 1, int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)
            if run:
                yield id, version, start + n - run, run, None, None


def _counted(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive ordered by bucket; each bucket is compared as soon as the next one begins."""
    kinds = pa.schema([(name, pa.int64()) for name in ("id", "version", "start", "n", "w_a", "w_b")])
    rows = (row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
    for _, own in groupby(rows, key=lambda r: r[0]):
        found = list(_compared([r[1] for r in own], window))
        for lo in range(0, len(found), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found[lo : lo + 100_000], strict=True)], schema=kinds)


def marks(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Runs of repeated windows: ``id``, ``version`` (a hash of the text, for rows that share an id), the word at which
    the first one starts, and how many follow one another."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    counts = rows.select("text").mapInArrow(lambda it: _frequent(it, window), "mini long, n long").groupBy("mini").agg(F.sum("n").alias("n"))
    largest = counts.filter((F.col("n") > HOT) | (F.col("mini") == 0)).orderBy((F.col("mini") == 0).desc(), F.desc("n")).limit(SPREAD).collect()
    size = sum(r["n"] for r in largest if r["mini"] == 0)
    listed = [(r["mini"], r["n"]) for r in largest if r["mini"] != 0]
    spread = spark.sparkContext.broadcast(Spread([m for m, _ in listed], [n for _, n in listed]))
    buckets = max(3 * size // BUCKET_BYTES, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    sent = rows.mapInArrow(lambda it: _sent(it, window, spread, buckets), "bucket long, runs binary")
    found = settle(sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _counted(it, window), FOUND))
    local = found.filter("w_a IS NULL").drop("w_a", "w_b")
    passed = found.filter("w_a IS NOT NULL")
    smallest = passed.groupBy("w_a", "w_b").agg(F.min("id").alias("smallest"))
    across = passed.join(smallest, ["w_a", "w_b"]).filter("id > smallest").select(local.columns)
    return local.union(across)


def _flags(n_words: int, found: list[dict] | None, window: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int64)
    for f in found or ():
        change[f["start"]] += 1
        change[f["start"] + f["n"] + window - 1] -= 1
    return np.cumsum(change[:-1]) > 0


def _with_marks(docs: DataFrame, id: str, text: str, window: int) -> DataFrame:
    """The documents, their texts compressed, with a last column that holds the marks of their text."""
    names = {n: next(c for c in (n + "_" * k for k in range(len(docs.columns) + 1)) if c not in docs.columns) for n in ("mark_id", "mark_version", "marks", "own_id", "own_version")}
    found = marks(docs, id, text, window).groupBy(F.col("id").alias(names["mark_id"]), F.col("version").alias(names["mark_version"])).agg(F.collect_list(F.struct("start", "n")).alias(names["marks"]))
    own = zipped(docs.withColumns({names["own_id"]: F.col(id).cast("long"), names["own_version"]: F.xxhash64(text)}), text)
    keys = (F.col(names["own_id"]) == F.col(names["mark_id"])) & (F.col(names["own_version"]) == F.col(names["mark_version"]))
    return own.join(found.hint("merge"), keys, "left").select(*docs.columns, names["marks"])


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Per row: the id, the number of words, of removed words, and the SHA-256 of the kept words joined by a space."""
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *T._parse_datatype_string("n_words long, n_removed long, kept_sha256 string").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, found in zip(unzipped(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                words = t.split()
                gone = _flags(len(words), found, window)
                kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words
                out.append((len(words), int(gone.sum()), hashlib.sha256(b" ".join(kept)).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array([r[c] for r in out], k) for c, k in enumerate(kinds))], names=schema.names)

    return _with_marks(docs.select(id, text), id, text, window).mapInArrow(run, schema)


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents, all columns, without the repeated words; ``n_chars`` follows where there is such a column.
    Documents of which nothing is left go; untouched ones stay as they are."""
    schema, at = docs.schema, docs.columns.index(text)
    counted = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, found = list(unzipped(batch.column(at))), batch.column(batch.num_columns - 1).to_pylist()
            keep = np.ones(batch.num_rows, bool)
            for i, f in enumerate(found):
                if f:
                    words = Words.of([texts[i]], SPACED)
                    gone = _flags(len(words.start), f, window)
                    texts[i], keep[i] = cut(texts[i], words, 0, 0, gone), not gone.all()
            texts = [None if null else t.decode("utf-8") for t, null in zip(texts, batch.column(at).is_null().to_pylist(), strict=True)]
            columns = list(batch.columns)[:-1]
            columns[at] = pa.array(texts, pa.string())
            if counted is not None:
                old = batch.column(counted).to_pylist()
                columns[counted] = pa.array([len(t) if f else n for n, t, f in zip(old, texts, found, strict=True)], batch.schema.field(counted).type)
            yield pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(keep))

    return _with_marks(docs, id, text, window).mapInArrow(run, schema)
