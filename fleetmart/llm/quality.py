"""Quality classifier: regularised quadratic discriminant analysis on document statistics.

Every whole text gives a vector of transformed statistics (lengths, character classes, repetition). For either class
the mean and the covariance come from one grouped sum over all labelled documents; the covariances are shrunk towards
their pooled value and towards a multiple of the identity. A score is the logistic of the difference of the two
log-densities, whose Mahalanobis distances use the inverses of Cholesky factors that are worked out once.

Defined results: a null text counts as empty; an empty text has a vector (and score) like any other; repeated rows
score alike; rows without a label are ignored in learning; a class without rows makes every score the share of the
other one; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.words import SPACED, Words, chunks, utf8

POOLED = 0.1  # weight of the pooled covariance
IDENTITY = 0.02  # weight of the identity, scaled to the mean variance
THRESHOLD = 0.3

_BYTES = np.arange(256)
_UPPER = ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
_LOWER = ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
_DIGIT = ((_BYTES >= 0x30) & (_BYTES <= 0x39))
_SPACE = ((_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D)))
_STOP = np.isin(_BYTES, np.frombuffer(b".,;:?", np.uint8))
_SYMBOL = (_BYTES < 0x80) & ~(_UPPER | _LOWER | _DIGIT | _SPACE | _STOP)
_CLASSES = (_UPPER, _DIGIT, _STOP, _SYMBOL, _BYTES == 0x0A, _BYTES == 0x7C, _UPPER | _LOWER | (_BYTES >= 0x80))

STATISTICS = ["log_words", "word_bytes", "upper", "digits", "stops", "symbols", "breaks", "bars", "letters", "distinct", "doubled", "near", "short"]


def _share(count: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A share on the logit scale, steadied by half a case each way."""
    return np.log((count + 0.5) / (np.maximum(of - count, 0) + 0.5))


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of transformed statistics for each text."""
    words = Words.of(texts, SPACED)
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    by_class = []
    for flags in _CLASSES:
        sums = np.concatenate([[0], np.cumsum(flags[raw])])
        by_class.append((sums[offsets[1:]] - sums[offsets[:-1]]).astype(float))
    upper, digits, stops, symbols, breaks, bars, letters = by_class
    size = (offsets[1:] - offsets[:-1] - 1).astype(float)
    n = np.diff(words.first).astype(float)

    hashes, doc = words.hashes(), words.document()
    order = np.lexsort((hashes, doc))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    count = lambda flags, at: np.bincount(at[flags], minlength=len(texts)).astype(float)
    distinct = count(new, doc[order])
    doubled = count((hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1]), doc[1:])
    near = count((hashes[2:] == hashes[:-2]) & (doc[2:] == doc[:-2]), doc[2:])
    lengths = words.end - words.start
    short = count(lengths <= 3, doc)
    word_bytes = np.bincount(doc, lengths, len(texts)) / np.maximum(n, 1)
    return np.stack([
        np.log1p(n), np.log1p(word_bytes), _share(upper, letters), _share(digits, size), _share(stops, size), _share(symbols, size), _share(breaks, n), _share(bars, n),
        _share(letters, size), _share(distinct, n), _share(doubled, n), _share(near, n), _share(short, n),
    ], axis=1)


def measured(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: its id and ``x``, the transformed statistics of the whole text."""
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics([utf8(t) for (t,) in part]) for part in chunks((t,) for t in batch.column(1).to_pylist())]
            x = np.concatenate(rows) if rows else np.zeros((0, len(STATISTICS)))
            column = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(STATISTICS), pa.int32()), pa.array(x.ravel(), pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), column], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """For the classes 0 and 1: means, inverses of the Cholesky factors, log-determinants; and the log prior odds."""

    means: np.ndarray
    inverses: np.ndarray
    logdets: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1, from the difference of the log-densities."""
        if not len(self.means):
            return np.full(len(x), 1 / (1 + math.exp(-self.prior)))
        density = [-0.5 * (((x - m) @ inv.T) ** 2).sum(axis=1) - 0.5 * d for m, inv, d in zip(self.means, self.inverses, self.logdets, strict=True)]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / len(STATISTICS) + self.prior, -50, 50)))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (x, label): count, sums and sums of products by class, as numbered cells."""
    d = len(STATISTICS)
    for batch in batches:
        x = batch.column(0).flatten().to_numpy().reshape(-1, d)
        y = batch.column(1).to_numpy()
        for c in (0, 1):
            own = x[y == c]
            cells = np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array([c] * len(cells), pa.int32()), pa.array(np.arange(len(cells)), pa.int32()), pa.array(cells)], names=["label", "cell", "value"])


def fit(labelled: DataFrame, x: str = "x", label: str = "quality", pooled: float = POOLED, identity: float = IDENTITY) -> Discriminant:
    """The discriminant for measured documents with labels. What reaches the driver is one sum for each cell."""
    d = len(STATISTICS)
    rows = labelled.filter(F.col(label).isin(0, 1) & F.col(x).isNotNull()).select(x, F.col(label).cast("int").alias("y"))
    total = np.zeros((2, 1 + d + d * d))
    for r in rows.mapInArrow(_sums, "label int, cell int, value double").groupBy("label", "cell").agg(F.sum("value").alias("value")).collect():
        total[r["label"], r["cell"]] = r["value"]
    n = total[:, 0]
    prior = math.log((n[1] + 0.5) / (n[0] + 0.5))
    if n.min() < 2:
        return Discriminant(np.zeros((0, d)), np.zeros((0, d, d)), np.zeros(0), prior)
    means = total[:, 1 : 1 + d] / n[:, None]
    covs = [total[c, 1 + d :].reshape(d, d) / n[c] - np.outer(means[c], means[c]) for c in (0, 1)]
    both = (n[0] * covs[0] + n[1] * covs[1]) / n.sum()
    inverses, logdets = [], []
    for cov in covs:
        shrunk = (1 - pooled) * cov + pooled * both
        shrunk = (1 - identity) * shrunk + identity * np.trace(shrunk) / d * np.eye(d)
        factor = np.linalg.cholesky(shrunk + 1e-9 * np.eye(d))
        inverses.append(np.linalg.inv(factor))
        logdets.append(2 * np.log(np.diag(factor)).sum())
    return Discriminant(means, np.array(inverses), np.array(logdets), prior)


def score(rows: DataFrame, model: Discriminant, x: str = "x") -> DataFrame:
    """Measured documents with their ``score`` in place of the statistics."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in rows.columns if c != x]
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(len(kept)).flatten().to_numpy().reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], pa.array(shared.value.score(values))], names=schema.names)

    return rows.select(*kept, x).mapInArrow(run, schema)
