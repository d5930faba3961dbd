"""Near duplicates by MinHash signatures and a multi-index Hamming join.

A signature has ``HASHES`` symbols of 16 bits. It is split into chunks of ``CHUNK`` symbols, and for every chunk each
way of leaving out ``ERRORS`` of its symbols gives a key. With m chunks, two signatures that differ in fewer than
m * (ERRORS + 1) symbols have, by the pigeonhole principle, a chunk with at most ERRORS differences, and so a key in
common: no pair within the distance is missed. At a similarity of 0.8 a signature of 80 symbols differs in 16 places
on average; more than 31 differ in some 2 of 100,000 such pairs, and in far fewer of more similar ones. Links are
confirmed on the full shingle sets.

No bucket's pairs are all written out:

* documents with the same shingle set are one class, represented by the smallest id;
* in every bucket the members are first compared with one centre, the least peculiar member, and what is linked
  forms components;
* only members of different components of a bucket can then still be linked. Either all that two of them share is
  the centre's, which bounds their similarity by what each shares with the centre, known by now; or they share a
  shingle that the centre hasn't, and meet under it;
* in crowded buckets the shingles that nobody else there has are counted (one grouped count). A document can only be
  linked to another of a size that its other shingles allow, which rules out exactly, without a comparison, what
  merely shares a passage with many documents or was edited too much.

Defined results: null texts and texts without words have the empty set and are linked with nothing; equal rows are
one class; rows with the same id are taken as one document, whose smallest text is compared; rows without an id are
never linked; an empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.words import LOWER_SPACED, Words, chunks, kgrams, mix, utf8
from fleetmart.operators.settle import settle

SHINGLE = 5
PERCENT = 80
HASHES, CHUNK, ERRORS = 80, 5, 1
DISTANCE = HASHES // CHUNK * (ERRORS + 1) - 1
CROWD = 16

_U = np.uint64
_FACTORS = mix(np.arange(1, HASHES + 1, dtype=_U)) | _U(1)
_TERMS = mix(np.arange(1001, 1001 + HASHES, dtype=_U))


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than ``size`` are one shingle."""
    words = Words.of(texts, LOWER_SPACED)
    hashes = words.hashes()
    grams = kgrams(hashes, size)
    out = []
    for lo, hi in zip(words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
        if hi - lo >= size:
            out.append(np.unique(grams[lo : hi - size + 1]))
        else:
            out.append(kgrams(hashes[lo:hi], hi - lo) if hi > lo else np.zeros(0, _U))
    return out


# signatures -----------------------------------------------------------------------------------------------------

SIGNED = "n_shingles long, digest_a long, digest_b long, signature binary"


def signature(sets: list[np.ndarray]) -> np.ndarray:
    """One row of 16-bit symbols for each non-empty set."""
    joined = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), HASHES), np.uint16)
    for j in range(HASHES):
        smallest = np.minimum.reduceat(joined * _FACTORS[j] + _TERMS[j], starts)
        out[:, j] = mix(smallest) & _U(0xFFFF)  # scrambled first: a minimum's leading bits are mostly zero
    return out


def signed(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE) -> DataFrame:
    """Per row: the id, the size of the shingle set, a 128-bit digest of the set, and the signature."""
    schema = T.StructType([T.StructField("id", docs.schema[id].dataType), *T._parse_datatype_string(SIGNED).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, a, b, signatures = [], [], [], []
            for part in chunks((t.as_py(),) for t in batch.column(1)):
                sets = shingle_sets([utf8(t) for (t,) in part], size)
                rows = iter(signature(full) if (full := [s for s in sets if len(s)]) else ())
                for s in sets:
                    counts.append(len(s))
                    a.append(int(mix(s).sum(dtype=_U).view(np.int64)) if len(s) else 0)
                    b.append(int(np.bitwise_xor.reduce(mix(s + _U(77))).view(np.int64)) if len(s) else 0)
                    signatures.append(next(rows).tobytes() if len(s) else None)
            columns = [pa.array(counts, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (rep, signature): a row for each chunk and each symbol left out of it."""
    for batch in batches:
        if not batch.num_rows:
            continue
        symbols = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(-1, HASHES).astype(_U)
        keys = np.empty((len(symbols), HASHES), _U)
        for j in range(HASHES):
            lo = j // CHUNK * CHUNK
            keys[:, j] = j + 1
            for i in range(lo, lo + CHUNK):
                if i != j:
                    keys[:, j] = mix(keys[:, j] ^ (symbols[:, i] << _U(16)) ^ _U(i))
        owners = batch.column(0).take(pa.array(np.repeat(np.arange(len(symbols)), HASHES)))
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), owners], names=["key", "rep"])


# comparisons ----------------------------------------------------------------------------------------------------


def _far(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, signature of a, of b): the pairs within the distance."""
    for batch in batches:
        if batch.num_rows:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, HASHES) for c in (2, 3))
            near = pa.array((x != y).sum(axis=1) <= DISTANCE)
            yield batch.select([0, 1]).filter(near)


def close(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose signatures are within the distance."""
    side = lambda c: reps.select(F.col("rep").alias(c), F.col("signature").alias(f"s{c}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "sa", "sb").mapInArrow(_far, pairs.select("a", "b").schema)


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, text of a, text of b); rows of one b follow one another."""
    side = lambda c: texts.select(F.col("rep").alias(c), F.col("text").alias(f"t{c}"))
    return pairs.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b").select("a", "b", "ta", "tb")


def _set_pairs(batch: pa.RecordBatch, size: int, last: list) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The shingle sets of each pair; that of b is kept in ``last`` for the rows that follow."""
    for b, ta, tb in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
        if not last or b != last[0]:
            last[:] = [b, shingle_sets([utf8(tb.as_py())], size)[0]]
        yield shingle_sets([utf8(ta.as_py())], size)[0], last[1]


def overlaps(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """The pairs (a, b) with ``an``, ``bn`` and ``both``: the sizes of their full shingle sets and of what they share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = []
        for batch in batches:
            counts = [(len(x), len(y), len(np.intersect1d(x, y, assume_unique=True))) for x, y in _set_pairs(batch, size, last)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3))], names=["a", "b", "an", "bn", "both"])

    schema = T.StructType([*pairs.select("a", "b").schema.fields, *T._parse_datatype_string("an long, bn long, both long").fields])
    return _with_texts(pairs, texts).mapInArrow(run, schema)


def alike(percent: int) -> F.Column:
    return 100 * F.col("both") >= percent * (F.col("an") + F.col("bn") - F.col("both"))


def outside(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """For each pair (a, b) the shingles ``h`` of a that b doesn't have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: list = []
        for batch in batches:
            rest = [np.setdiff1d(x, y, assume_unique=True) for x, y in _set_pairs(batch, size, last)]
            if rest:
                at = pa.array(np.repeat(np.arange(len(rest)), [len(r) for r in rest]))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(np.concatenate(rest).view(np.int64))], names=["a", "b", "h"])

    schema = T.StructType([*pairs.select("a", "b").schema.fields, T.StructField("h", T.LongType())])
    return _with_texts(pairs, texts).mapInArrow(run, schema)


def components(links: DataFrame) -> DataFrame:
    """For each end of a link, the smallest id reachable. Rounds of neighbour minima and pointer jumping, each
    written to the shared folder, until nothing changes."""
    both = settle(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")))
    while True:
        heard = both.join(labels.select(F.col("a").alias("b"), F.col("label").alias("theirs")), "b").groupBy("a").agg(F.min("theirs").alias("theirs"))
        heard = labels.join(heard, "a").select("a", F.col("label").alias("old"), F.least("label", "theirs").alias("label"))
        up = labels.select(F.col("a").alias("label"), F.col("label").alias("top"))
        after = settle(heard.join(up, "label", "left").select("a", "old", F.least("label", F.coalesce("top", "label")).alias("label")))
        if after.filter("label <> old").isEmpty():
            return after.select("a", "label")
        labels = after.select("a", "label")


def fits(a: str, b: str, percent: int) -> F.Column:
    """Whether sizes n and shared parts m of two members of a crowd leave room for the similarity: the intersection
    can't exceed the smaller shared part."""
    most = F.least(f"{a}m", f"{b}m")
    return 100 * most >= percent * (F.col(f"{a}n") + F.col(f"{b}n") - most)


# the operator ---------------------------------------------------------------------------------------------------


def _peculiar(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """From (rep, text): a row for each shingle, by 32 bits of its hash; where two fall together they count as shared, which only leaves more to compare."""
    for batch in batches:
        for part in chunks(((i, t.as_py()) for i, t in enumerate(batch.column(1))), at=1):
            sets = shingle_sets([utf8(t) for _, t in part], size)
            rows = np.repeat(np.array([r for r, _ in part]), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array((np.concatenate(sets) >> _U(32)).astype(np.uint32).view(np.int32))], names=["rep", "h"])


def classes(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    if percent < 80:
        raise ValueError("the signature distance covers similarities of 0.8 and more")
    kind = docs.schema[id].dataType.simpleString()
    marks = settle(signed(docs, id, text, size))
    same = ["n_shingles", "digest_a", "digest_b"]
    full = marks.filter("n_shingles > 0 AND id IS NOT NULL")
    firsts = settle(full.groupBy(*same).agg(F.min(F.struct("id", "signature")).alias("f")).select(*same, F.col("f.id").alias("rep"), F.col("f.signature").alias("signature")))
    reps = firsts.groupBy("rep").agg(F.min("signature").alias("signature"), F.min("n_shingles").alias("n"))

    buckets = firsts.select("rep", "signature").mapInArrow(_keys, f"key long, rep {kind}")
    counts = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    shared = settle(buckets.join(counts, "key"))
    wanted = shared.select("rep").distinct()
    texts = settle(docs.select(F.col(id).alias("rep"), F.col(text).alias("text")).join(wanted.hint("merge"), "rep").groupBy("rep").agg(F.min("text").alias("text")))

    crowded = shared.filter(F.col("members") > CROWD).select("rep").distinct()
    alone = (
        texts.join(crowded.hint("merge"), "rep").mapInArrow(lambda it: _peculiar(it, size), f"rep {kind}, h int")
        .groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep")).filter("n = 1").groupBy("rep").agg(F.count(F.lit(1)).alias("alone"))
    )
    # m: shingles that another member of a crowd can have; outside crowds all of them
    known = settle(
        wanted.join(reps.select("rep", "n"), "rep").join(crowded.withColumn("crowd", F.lit(True)), "rep", "left").join(alone, "rep", "left")
        .select("rep", "n", F.when(F.col("crowd"), F.col("n") - F.coalesce("alone", F.lit(0))).otherwise(F.col("n")).alias("m"))
    )
    inside = shared.join(known, "rep").withColumn("m", F.when(F.col("members") > CROWD, F.col("m")).otherwise(F.col("n"))).filter(100 * F.col("m") >= percent * F.col("n"))
    inside = settle(inside.select("key", "rep", "n", "m"))
    centre = F.min(F.struct((1 - F.col("m") / F.col("n")).alias("share"), F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("m").alias("bm"))).alias("c")
    centres = inside.groupBy("key").agg(centre).select("key", "c.b", "c.bn", "c.bm")
    stars = (
        inside.select("key", F.col("rep").alias("a"), F.col("n").alias("an"), F.col("m").alias("am")).join(centres, "key")
        .filter((F.col("a") != F.col("b")) & fits("a", "b", percent)).select("a", "b").distinct()
    )
    stars = settle(overlaps(stars, texts, size))
    links = stars.filter(alike(percent)).select("a", "b")

    # what a bucket still holds apart
    found = components(links)
    apart = inside.join(found.withColumnRenamed("a", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    mixed = apart.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("key")
    of_centre = stars.select(F.col("a").alias("rep"), F.col("b").alias("c"), "both")
    apart = apart.join(mixed, "key").join(centres.select("key", F.col("b").alias("c")), "key").join(of_centre, ["rep", "c"], "left")
    apart = settle(apart.withColumn("both", F.when(F.col("rep") == F.col("c"), F.col("n")).otherwise(F.col("both"))))
    side = lambda df, c, *more: df.select(*more, F.col("rep").alias(c), F.col("n").alias(f"{c}n"), F.col("m").alias(f"{c}m"), F.col("label").alias(f"{c}l"))
    open_pair = (F.col("a") < F.col("b")) & (F.col("al") != F.col("bl")) & fits("a", "b", percent)
    # two members either have no shingle in common but the centre's, so that what they share with it bounds them ...
    bounded = apart.withColumn("m", F.least("m", F.coalesce("both", "m")))
    within = side(bounded, "a", "key").join(side(bounded, "b", "key"), "key").filter(open_pair).select("a", "b")
    # ... or shingles that the centre hasn't, which are counted
    members = settle(apart.groupBy("rep", "c").agg(F.first("n").alias("n"), F.max("m").alias("m"), F.first("label").alias("label"), F.first("both").alias("both")))
    beside = outside(members.filter("rep <> c").select(F.col("rep").alias("a"), F.col("c").alias("b")), texts, size)
    beside = settle(beside.select(F.col("a").alias("rep"), F.col("b").alias("c"), "h").join(members, ["rep", "c"]))
    shared_by = beside.groupBy("c", "h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo < hi").select("c", "h")
    beside = settle(beside.join(shared_by, ["c", "h"]).withColumn("kept", F.coalesce("both", "m")))
    met = side(beside, "a", "c", "h", F.col("kept").alias("ak")).join(side(beside, "b", "c", "h", F.col("kept").alias("bk")), ["c", "h"]).filter(open_pair)
    met = met.groupBy("a", "b", "c", "an", "bn").agg((F.least(F.min("ak"), F.min("bk")) + F.count(F.lit(1))).alias("most"))
    across = met.groupBy("a", "b", "an", "bn").agg(F.min("most").alias("most")).filter(100 * F.col("most") >= percent * (F.col("an") + F.col("bn") - F.col("most"))).select("a", "b")
    more = overlaps(close(within.union(across).distinct(), reps), texts, size).filter(alike(percent)).select("a", "b")
    found = components(settle(links.union(more)))

    of_class = firsts.select(*same, "rep").join(found.withColumnRenamed("a", "rep"), "rep", "left").select(*same, F.coalesce("label", "rep").alias("label"))
    return marks.join(of_class, same, "left").select(F.col("id").alias(id), "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("id").isNotNull(), F.coalesce("label", "id")).otherwise(F.col("id")).alias("component_id"))


def keep_one(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The documents, all columns, but those whose class has a smaller id."""
    out = classes(docs, id, text, size, percent).filter(F.col("component_id") < F.col(id)).select(id).distinct()
    return docs.join(out.hint("merge"), id, "left_anti")
