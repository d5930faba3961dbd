"""Document fingerprints by order MinHash, sensitive to edit distance.

A text is a list of atoms: a run of ASCII letters and digits (cut every eight), or any other single character but white
space. Every K consecutive atoms, with the number of times they occurred before, are hashed. The hash space is cut
into PARTS; in every part the TUPLE smallest hashes are selected, put in the order in which they stand in the text, and
hashed together. So a part agrees between two texts if it selects the same k-mers, in the same order. A fingerprint is
the list of its parts, 16 bits each in hexadecimal; a part without a k-mer is zero. The likeness of two fingerprints is
the share of equal parts among those that either has.

Defined results: ids are numbers, in whose order the next document stands; a null text is empty; a text of fewer than K atoms has one k-mer of what there is; a text without
atoms has the empty fingerprint (all zero), which is like itself (1) and like nothing else (0); equal texts have equal
fingerprints; an empty table gives an empty table; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.words import kgrams, mix, utf8, word_hashes

K = 2
PARTS = 128
TUPLE = 2

_U = np.uint64
_BYTES = np.arange(256)
_RUN = ((_BYTES >= 0x30) & (_BYTES <= 0x39)) | ((_BYTES >= 0x41) & (_BYTES <= 0x5A)) | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
_SPACE = (_BYTES == 0x20) | ((_BYTES >= 0x09) & (_BYTES <= 0x0D))
_INNER = (_BYTES >= 0x80) & (_BYTES < 0xC0)  # later bytes of a character
_CLASS = np.where(_RUN, 1, np.where(_SPACE, 0, np.where(_INNER, 3, 2))).astype(np.uint8)


def atoms(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the atoms of a text's bytes."""
    kind = _CLASS[data]
    before = np.concatenate([np.zeros(1, np.uint8), kind[:-1]])
    run_start = (kind == 1) & (before != 1)
    at = np.arange(len(kind))
    since = at - np.maximum.accumulate(np.where(run_start, at, 0))
    starts = np.flatnonzero(((kind == 1) & (run_start | (since % 8 == 0))) | (kind == 2))
    inside = np.concatenate([kind != 0, [False]])
    stops = np.flatnonzero(~inside)  # white space or the end
    ends = np.minimum(np.append(starts[1:], len(data)), stops[np.searchsorted(stops, starts)]) if len(starts) else starts
    return starts, ends


def fingerprint(text: bytes) -> np.ndarray:
    """The parts of a text's fingerprint."""
    parts = np.zeros(PARTS, np.uint16)
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return parts
    starts, ends = atoms(data)
    if not len(starts):
        return parts
    grams = kgrams(word_hashes(data, starts, ends), min(K, len(starts)))
    # the occurrence number: a stable sort puts equal k-mers together in text order
    order = np.argsort(grams, kind="stable")
    same = grams[order]
    new = np.ones(len(same), bool)
    new[1:] = same[1:] != same[:-1]
    at = np.arange(len(same))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    hashes = np.empty_like(grams)
    hashes[order] = mix(same + mix(number.astype(_U)))
    part = (hashes >> _U(57)).astype(np.int64)
    # the smallest of each part: hashes in ascending order are in part order too
    by_hash = np.argsort(hashes)
    first = np.searchsorted(part[by_hash], np.arange(PARTS + 1))
    rank = np.arange(len(hashes)) - first[part[by_hash]]
    chosen = np.sort(by_hash[rank < TUPLE])  # back in text order
    owner = part[chosen]
    order = np.argsort(owner, kind="stable")
    chosen, owner = chosen[order], owner[order]
    value = np.zeros(PARTS, _U)
    place = np.arange(len(owner)) - np.searchsorted(owner, owner)
    for t in range(TUPLE):
        own = place == t
        value[owner[own]] = mix(value[owner[own]] * _U(31) + hashes[chosen[own]])
    has = np.zeros(PARTS, bool)
    has[owner] = True
    parts[has] = (value[has] >> _U(48)).astype(np.uint16) | np.uint16(1)
    return parts


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The share of equal parts among those that either text has."""
    either = (a != 0) | (b != 0)
    return float(((a == b) & either).sum() / either.sum()) if either.any() else 1.0


def shown(parts: np.ndarray) -> str:
    return parts.astype(">u2").tobytes().hex()


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the id and ``fingerprint``."""
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shown(fingerprint(utf8(t.as_py()))) for t in batch.column(1)], pa.string())], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


def with_next(docs: DataFrame, id: str, text: str, ranges: int) -> DataFrame:
    """(range, id, text, own) with the rows of each range of ids in one place, and the first row of the next range
    after them (own: false). The ranges are cut at quantiles of the ids; what reaches the driver is one number for each."""
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).filter("id IS NOT NULL")
    cuts = rows.agg(F.percentile_approx("id", [(i + 1) / ranges for i in range(ranges)], 10_000).alias("cuts")).first()["cuts"] or []
    edges = sorted(set(cuts))[:-1]  # a row belongs to the range of the first cut that is not below it
    numbered = rows.withColumn("range", F.lit(0) if not edges else F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col("id"))))
    firsts = {r["range"]: r["id"] for r in numbered.groupBy("range").agg(F.min("id").alias("id")).collect()}
    held = sorted(firsts)
    before = {firsts[r]: held[n - 1] for n, r in enumerate(held)}  # the first row of all follows the last range
    guest = numbered.filter(F.col("id").isin(list(before))) if before else numbered.limit(0)
    kind = docs.schema[id].dataType
    table = F.create_map(*(x for key, to in before.items() for x in (F.lit(key).cast(kind), F.lit(to)))) if before else F.lit(None).cast(T.MapType(kind, T.IntegerType()))
    guest = guest.withColumn("range", table[F.col("id")]).withColumn("own", F.lit(False))
    wrapped = (guest["range"] == held[-1]) & (F.col("id") == firsts[held[0]]) if held else F.lit(False)
    guest = guest.withColumn("last", F.lit(1) + wrapped.cast("int"))
    own = numbered.withColumn("own", F.lit(True)).withColumn("last", F.lit(0))
    return own.unionByName(guest).repartition("range").sortWithinPartitions("range", "last", "id", "text").select("range", "id", "text", "own")


def edited(docs: DataFrame, id: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Per row, in the order of ids (rows of one id: of texts; after the last the first): ``n_chars``, the digest of
    the edited text, whose last half gives way to the beginning of the next text, both fingerprints, and their
    likeness to each other and to the next text's. Rows without an id are left out."""
    ranges = ranges or 3 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *T._parse_datatype_string("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double").fields])
    kinds = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row that waits for the next one of its range
        for batch in batches:
            out, ids = [], []
            for range_, key, t, own in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), batch.column(3).to_pylist(), strict=True):
                t = t.as_py()
                mark = fingerprint(utf8(t))
                if held is not None and held[0] == range_ and held[4]:
                    half = len(held[2]) // 2
                    changed = utf8(held[2][: len(held[2]) - half] + t[:half])
                    other = fingerprint(changed)
                    ids.append(held[1])
                    out.append((len(held[2]), hashlib.sha256(changed).hexdigest(), shown(held[3]), shown(other), likeness(held[3], other), likeness(held[3], mark)))
                held = (range_, key, t, mark, own)
            yield pa.RecordBatch.from_arrays([pa.array([k.as_py() for k in ids], batch.column(1).type), *(pa.array([r[c] for r in out], k) for c, k in enumerate(kinds))], names=schema.names)

    return with_next(docs, id, text, ranges).mapInArrow(run, schema)
