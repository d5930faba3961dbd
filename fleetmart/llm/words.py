"""Words, word hashes and rolling k-gram hashes of a chunk of texts, in numpy, for use inside tasks.

A chunk is a list of texts of about a megabyte; a longer text is a chunk of its own. Nothing here keeps state
between chunks, so memory is bounded by the longest text.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CHUNK = 1 << 20

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = _U(0xD6E8FEB86659FD93)


def _classes(separators: Iterable[int]) -> bytes:
    table = bytearray(range(256))
    for c in range(0x41, 0x5B):
        table[c] = c + 32
    for c in separators:
        table[c] = 0x20
    return bytes(table)


#: lower-cases A-Z; everything below 0x80 that is not a letter or digit separates
ALNUM = _classes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
#: lower-cases A-Z; white space separates
LOWER_SPACED = _classes(range(0x09, 0x0E))
#: white space separates, letters stay as they are
SPACED = bytes(0x20 if 0x09 <= c <= 0x0D else c for c in range(256))


def utf8(text: str | None) -> bytes:
    return text.encode("utf-8", "replace") if text else b""


def zipped(docs: DataFrame, text: str) -> DataFrame:
    """The same rows with compressed texts, for a shuffle; null stays null. :func:`unzipped` reads them."""
    at = docs.columns.index(text)
    schema = T.StructType([T.StructField(text, T.BinaryType()) if i == at else f for i, f in enumerate(docs.schema.fields)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([None if t is None else zstd.compress(utf8(t)) for t in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def unzipped(column: pa.Array) -> Iterator[bytes]:
    """The texts of :func:`zipped`, in UTF-8; null gives an empty one."""
    zstd = zstandard.ZstdDecompressor()
    return (zstd.decompress(t.as_py()) if t.is_valid else b"" for t in column)


def chunks(rows: Iterable[tuple], at: int = 0, limit: int = CHUNK) -> Iterator[list[tuple]]:
    """Rows in lists whose texts (element ``at``) hold about ``limit`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[at] or "") + 64
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


@dataclass
class Words:
    """``data`` is the mapped text of all documents; word ``i`` is ``data[start[i]:end[i]]``; document ``d`` has the
    words ``first[d]`` to ``first[d + 1]``."""

    data: bytes
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], table: bytes) -> Words:
        data = b" ".join([*texts, b""]).translate(table)
        offsets = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
        inside = np.empty(len(data) + 2, bool)
        inside[0] = inside[-1] = False
        np.not_equal(np.frombuffer(data, np.uint8), 0x20, out=inside[1:-1])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edges[0::2], edges[1::2]
        return cls(data, start, end, np.searchsorted(start, offsets))

    def text(self, i: int, j: int) -> bytes:
        """Words ``i`` to ``j`` (exclusive) with one space between them."""
        return b" ".join(self.data[self.start[i] : self.end[j - 1]].split())

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        return word_hashes(np.frombuffer(self.data, np.uint8), self.start, self.end)

    def whole(self, k: int) -> np.ndarray:
        """For each position that k words follow in the chunk: whether they are of one document."""
        n = len(self.start) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        last = np.repeat(self.first[1:], np.diff(self.first))[:n]
        return np.arange(n) + k <= last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_POWERS = np.ones(1, _U)
_INVERSE = np.ones(1, _U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POWERS, _INVERSE
    if len(_POWERS) < n:
        _POWERS = np.full(n, _BASE & (2**64 - 1), _U)
        _INVERSE = np.full(n, pow(_BASE, -1, 2**64), _U)
        _POWERS[0] = _INVERSE[0] = 1
        np.multiply.accumulate(_POWERS, out=_POWERS)
        np.multiply.accumulate(_INVERSE, out=_INVERSE)
    return _POWERS, _INVERSE


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, the same in every process."""
    out = np.empty(len(start), _U)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + block, "right")))
        lo, hi = int(start[i]), int(end[j - 1])
        powers, inverse = _powers(max(block, hi - lo) + 1)
        sums = np.zeros(hi - lo + 1, _U)
        np.cumsum((data[lo:hi].astype(_U) + _U(1)) * powers[: hi - lo], out=sums[1:])
        s, e = start[i:j] - lo, end[i:j] - lo
        out[i:j] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(_U) * _STEP
        i = j
    return mix(out)


def kgrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each k consecutive word hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, _U)
    g = hashes[:n].copy()
    for j in range(1, k):
        g *= _STEP
        g += hashes[j : j + n]
    return mix(g)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` consecutive values."""
    n, have = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    out = values
    while have * 2 <= width:
        out = np.minimum(out[: len(out) - have], out[have:])
        have *= 2
    return np.minimum(out[:n], out[width - have : width - have + n]) if have < width else out[:n]


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end (exclusive) of each run of true values."""
    padded = np.zeros(len(flags) + 2, bool)
    padded[1:-1] = flags
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    return edges[0::2], edges[1::2]


def cut(text: bytes, words: Words, doc: int, base: int, removed: np.ndarray) -> bytes:
    """``text`` (document ``doc``, whose bytes begin at ``base`` of the chunk) without the words flagged in
    ``removed``; each gap closes up to the start of the next kept word."""
    lo, hi = words.first[doc], words.first[doc + 1]
    out, at = [], 0
    for s, e in zip(*runs(removed), strict=True):
        out.append(text[at : words.start[lo + s] - base])
        at = (words.start[lo + e] - base) if lo + e < hi else len(text)
    out.append(text[at:])
    return b"".join(out)
