"""Exact similarity join of texts in the metric space of the Jaccard distance.

Documents are sets of word shingles; 1 - J is a metric, and two sets are linked where it is at most EPS = 1 - percent /
100. Equal sets are one point.

1. *Isolated points.* A set can only be linked if at least ``percent`` of it occurs in other sets. That is counted
   exactly, in one shuffle of packed hashes: a chunk of documents sends one row to each range of hashes, and the range
   answers how many of each set's hashes other sets have. What fails is left out; the counts never fall short.
2. *Pivots.* Two linked sets share a hash among the first few of each, rarest first, its anchors. The least peculiar
   set of an anchor's group is a pivot: the region of a pivot is made of the groups that chose it. A set lies in every
   region it may have a partner in, so both ends of every link meet in a region, and their distances to its pivot are
   known, computed once on the full sets.
3. *Windows.* All sets within EPS of a pivot are linked with it and need no comparison with each other. What is left
   are pairs with an outer set, one whose component isn't the pivot's; by the triangle inequality its partners' distances to
   the pivot differ from its own by at most EPS. Sets outside every such window are dropped from the region.
4. *Regions join recursively.* A region that is too large for a task is cut into rings of distance to the pivot, and an outer set
   visits the rings of its window. In a task a region chooses pivots of its own, gives each set to the nearest, and a
   query visits a cell if its distance to the pivot is at most the cell's radius + EPS; it ends in comparisons of the full sets.

Nothing is dropped, capped or sampled: the bounds only rule out what cannot be linked.

Defined results: null texts and texts without words have the empty set and are linked with nothing; a text with fewer
words than a shingle is one shingle; rows of equal sets are linked; rows of one id with different texts are compared
each by its own text; rows without an id are never linked and have no component; an empty table gives no rows; further
columns don't matter. Sets are told apart by a 64-bit digest and the words of shingles by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.llm.neardup import components, shingle_sets
from fleetmart.llm.words import chunks, mix, unzipped, utf8, zipped
from fleetmart.operators.settle import settle

SHINGLE = 5
PERCENT = 80
RANGE = 1 << 21  # hashes that one range of the count holds
REGION = 1 << 21  # hashes that one task holds of a region
RINGS = 20  # rings of a region that is cut
LEAF = 1 << 12  # pairs up to which a cell is compared directly
CHUNK = 1 << 22

_U = np.uint64
_SLACK = 1e-9


def _digest(hashes: np.ndarray) -> int:
    return int(mix(hashes).sum(dtype=_U).view(np.int64))


def _sets(texts: Iterable[bytes], size: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Row numbers and shingle sets of the texts, chunk by chunk."""
    for part in chunks(enumerate(texts), at=1, limit=CHUNK):
        yield [i for i, _ in part], shingle_sets([t for _, t in part], size)


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (utf8(t.as_py()) for t in column)


def measured(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """Per row: the id, a hash of the text, ``n`` shingles and the digest of the set."""
    schema = T.StructType([T.StructField("id", docs.schema[id].dataType), *T._parse_datatype_string("version long, n long, a long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _sets(_texts(batch.column(2)), size):
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(at)) for c in (0, 1)), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.int64())], names=schema.names
                )

    return docs.select(F.col(id), F.xxhash64(text), F.col(text)).mapInArrow(run, schema)


# isolated points -------------------------------------------------------------------------------------------------

_PACKED = "range int, chunk long, sets binary, known binary, counts binary, single binary, multi binary"


def _packed(batches: Iterator[pa.RecordBatch], size: int, ranges: int) -> Iterator[pa.RecordBatch]:
    """For each chunk and range of hashes one row: the chunk's sets there, how many of their hashes other sets of the
    chunk have (``known``) and how many they have alone (``counts``), the latter hashes set by set (``single``), and the
    former, each once (``multi``)."""
    for batch in batches:
        for _, found in _sets(_texts(batch.column(0)), size):
            distinct = {_digest(s): s for s in found if len(s)}
            if not distinct:
                continue
            digests = np.array(list(distinct), np.int64)
            hashes = np.concatenate(list(distinct.values()))
            owner = np.repeat(np.arange(len(digests)), [len(s) for s in distinct.values()])
            to = ((hashes >> _U(32)) % _U(ranges)).astype(np.int64)
            low = (hashes & _U(0xFFFFFFFF)).astype(np.uint32)
            order = np.lexsort((low, to))
            hashes, owner, to, low = hashes[order], owner[order], to[order], low[order]
            new = np.ones(len(to) + 1, bool)
            new[1:-1] = (to[1:] != to[:-1]) | (low[1:] != low[:-1])
            alone = new[:-1] & new[1:]
            chunk = int(mix(digests.view(_U) + np.arange(len(digests), dtype=_U)).sum(dtype=_U).view(np.int64))
            edges = np.searchsorted(to, np.arange(ranges + 1))
            rows: list[tuple] = []
            for r in range(ranges):
                cut = slice(edges[r], edges[r + 1])
                if edges[r] == edges[r + 1]:
                    continue
                mine, own, hs = alone[cut], owner[cut], low[cut]
                counts, known = np.bincount(own[mine], minlength=len(digests)), np.bincount(own[~mine], minlength=len(digests))
                there = np.flatnonzero(counts + known)
                by_set = np.argsort(own[mine], kind="stable")
                rows.append((r, chunk, digests[there].tobytes(), known[there].astype(np.uint32).tobytes(), counts[there].astype(np.uint32).tobytes(), hs[mine][by_set].tobytes(), hs[~mine & new[:-1][cut]].tobytes()))
            kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], k) for c, k in enumerate(kinds)], names=[f.split()[0] for f in _PACKED.split(", ")])


def _answered(table: pa.Table) -> pa.Table:
    """For each row of a range an answer: the sets, and how many of their hashes there another set has."""
    read = lambda c, kind: [np.frombuffer(x, kind) for x in table.column(c).to_pylist()]
    sets, known, counts, single = read("sets", np.int64), read("known", np.uint32), read("counts", np.uint32), np.concatenate(read("single", np.uint32))
    multi = np.unique(np.concatenate(read("multi", np.uint32)))
    number = np.repeat(np.arange(sum(map(len, sets))), np.concatenate(counts))
    digests = np.concatenate(sets)
    order = np.argsort(single, kind="stable")
    same, owner = single[order], digests[number[order]]
    starts = np.flatnonzero(np.concatenate([[True], same[1:] != same[:-1]])) if len(same) else np.zeros(0, np.int64)
    m = np.concatenate(known).astype(np.int64)
    if len(starts):
        met = np.minimum.reduceat(owner, starts) != np.maximum.reduceat(owner, starts)
        at = np.searchsorted(multi, same[starts])
        met |= (at < len(multi)) & (multi[np.minimum(at, len(multi) - 1)] == same[starts]) if len(multi) else False
        m += np.bincount(number[order][np.repeat(met, np.diff(np.append(starts, len(same))))], minlength=len(m))
    of_row = np.split(m, np.cumsum([len(s) for s in sets])[:-1])
    return pa.table({"chunk": table.column("chunk"), "sets": pa.array([s[k > 0].tobytes() for s, k in zip(sets, of_row, strict=True)]), "m": pa.array([k[k > 0].tobytes() for k in of_row])})


def _summed(table: pa.Table) -> pa.Table:
    """The answers to a chunk, added by set."""
    read = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), np.int64)
    digests, at = np.unique(read("sets"), return_inverse=True)
    return pa.table({"a": digests, "m": np.bincount(at, read("m"), len(digests)).astype(np.int64)})


def shared(docs: DataFrame, text: str, size: int, total: int) -> DataFrame:
    """(a, m): at most ``m`` hashes of the set with digest ``a`` are in other sets; sets with none are left out. The
    bound is exact but for hashes that agree in 32 bits and the range."""
    ranges = max(1, -(-total // RANGE))
    rows = docs.select(text).mapInArrow(lambda it: _packed(it, size, ranges), _PACKED)
    answers = rows.groupBy("range").applyInArrow(_answered, "chunk long, sets binary, m binary")
    # every chunk that holds a set counts it whole, with the same result
    return answers.groupBy("chunk").applyInArrow(_summed, "a long, m long").groupBy("a").agg(F.max("m").alias("m"))


def point_sets(docs: DataFrame, points: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """(a, n, s) of the points (a, n, id, version): their sets as sorted arrays. The texts go to their points compressed."""
    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("version"), F.col(text).alias("text"))
    rows = zipped(rows, "text").join(points.select("id", "version", "a", "n").hint("merge"), ["id", "version"]).dropDuplicates(["id", "version"])
    schema = T._parse_datatype_string("a long, n long, s array<long>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets in _sets(unzipped(batch.column(2)), size):
                offsets = pa.array(np.cumsum([0, *(len(s) for s in sets)]), pa.int32())
                s = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(at)) for c in (0, 1)), s], names=schema.names)

    return rows.select("a", "n", "text").mapInArrow(run, schema)


# pivots and regions ----------------------------------------------------------------------------------------------


def anchors(sets: DataFrame, percent: int) -> DataFrame:
    """(h, a, n, m): the rarest hashes of each set, as many as it takes for two linked sets to have one in common;
    hashes that nobody else has come first and need no row. ``m`` hashes of the set are shared."""
    rows = sets.select("a", "n", F.explode("s").alias("h"))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    own = Window.partitionBy("a")
    rows = rows.hint("merge").join(counts.hint("merge"), "h").withColumn("m", F.count(F.lit(1)).over(own)).withColumn("rank", F.row_number().over(own.orderBy("df", "h")))
    return rows.filter(F.col("rank") <= F.col("m") - F.floor((percent * F.col("n") + 99) / 100) + 1).select("h", "a", "n", "m")


def alike(percent: int, both: str = "both") -> F.Column:
    return 100 * F.col(both) >= percent * (F.col("n") + F.col("cn") - F.col(both))


def met(marks: DataFrame, sets: DataFrame) -> DataFrame:
    """(c, a, n, cn, both): each set with each pivot that it meets, and what they share of their full sets."""
    peculiar = F.struct((1 - F.col("m") / F.col("n")).alias("p"), F.col("a").alias("c"))
    pivots = marks.groupBy("h").agg(F.min(peculiar).alias("least"), F.count(F.lit(1)).alias("members")).filter("members > 1").select("h", F.col("least.c").alias("c"))
    pairs = marks.hint("merge").join(pivots.hint("merge"), "h").filter("a <> c").select("a", "c").distinct()
    of_a, of_c = sets.select("a", "n", "s"), sets.select(F.col("a").alias("c"), F.col("n").alias("cn"), F.col("s").alias("cs"))
    return pairs.hint("merge").join(of_a.hint("merge"), "a").join(of_c.hint("merge"), "c").select("c", "a", "n", "cn", F.size(F.array_intersect("s", "cs")).cast("long").alias("both"))


def boundary(found: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """What regions still hold apart: (c, a, n, label, outer, d) of the sets that have a possible partner of another
    component in the window of EPS around their distance ``d`` to the pivot."""
    eps = 1 - percent / 100
    members = found.select("c", "a", "n", (1 - F.col("both") / (F.col("n") + F.col("cn") - F.col("both"))).alias("d"))
    members = members.union(found.groupBy("c").agg(F.min("c"), F.first("cn"), F.lit(0.0)))
    of = lambda c: labels.select(F.col("a").alias(c), F.col("label").alias(f"label_{c}"))
    members = members.join(of("a").hint("merge"), "a", "left").join(of("c").hint("merge"), "c", "left")
    members = members.select("c", "a", "n", "d", F.coalesce("label_a", "a").alias("label"), (F.coalesce("label_a", "a") != F.coalesce("label_c", "c")).alias("outer"))
    nearest = members.filter("outer").groupBy("c").agg(F.min("d").alias("nearest"))
    return members.join(nearest.hint("merge"), "c").filter(F.col("outer") | (F.col("d") >= F.col("nearest") - eps - _SLACK)).drop("nearest")


def blocks(rows: DataFrame, percent: int, limit: int) -> DataFrame:
    """The rows of :func:`boundary` with the block (c, ring, slot) of each: every set is a resident of one block, and
    outer sets visit the other blocks of their region whose distances are in their window."""
    total = rows.groupBy("c").agg(F.sum("n").alias("total"))
    rows = rows.join(total.hint("merge"), "c").withColumn("ring", F.when(F.col("total") > limit, F.floor(F.col("d") * RINGS).cast("int")).otherwise(0))
    rings = rows.groupBy("c", "ring").agg(F.ceil(F.sum("n") / limit).cast("int").alias("slots"))
    mine = rows.join(rings.hint("merge"), ["c", "ring"]).withColumn("slot", F.pmod(F.xxhash64("a"), F.col("slots")).cast("int"))
    of_all = rings.select("c", F.col("ring").alias("there"), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("visited"))
    window = F.abs(F.col("ring") - F.col("there")) <= -(-(100 - percent) * RINGS // 100) + 1
    guests = mine.filter(F.col("outer") & ((F.col("total") > limit) | (F.col("slots") > 1))).join(of_all.hint("merge"), "c")
    guests = guests.filter(window & ((F.col("ring") != F.col("there")) | (F.col("slot") != F.col("visited"))))
    columns = lambda ring, slot, resident: ["c", F.col(ring).alias("ring"), F.col(slot).alias("slot"), "a", "n", "label", "outer", F.lit(resident).alias("resident"), "d"]
    return mine.select(*columns("ring", "slot", True)).union(guests.select(*columns("there", "visited", False)))


class _Region:
    """The sets of a block, and the components known in it."""

    def __init__(self, table: pa.Table, percent: int) -> None:
        self.percent, self.eps = percent, 1 - percent / 100 + _SLACK
        self.a, self.label, self.d = (table.column(c).to_pylist() for c in ("a", "label", "d"))
        s = table.column("s").combine_chunks()
        flat, offsets = s.flatten().to_numpy().view(_U), s.offsets.to_numpy()
        self.sets = [flat[i - offsets[0] : j - offsets[0]] for i, j in zip(offsets[:-1], offsets[1:], strict=True)]
        self.n = np.array([len(x) for x in self.sets])
        self.d = np.array(self.d)
        self.top: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        x = self.label[i]
        while (y := self.top.get(x, x)) != x:
            self.top[x] = x = self.top.get(y, y)
        return x

    def index(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes, owner = np.concatenate([self.sets[i] for i in members]), np.repeat(np.arange(len(members)), self.n[members])
        order = np.argsort(hashes, kind="stable")
        return hashes[order], owner[order]

    def similarity(self, query: int, members: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """The sizes of the intersections of a set with the members'."""
        hashes, owner = index
        lo, hi = np.searchsorted(hashes, self.sets[query]), np.searchsorted(hashes, self.sets[query], "right")
        lens = hi - lo
        at = np.repeat(lo - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
        return np.bincount(owner[at], minlength=len(members))

    def compare(self, query: int, members: np.ndarray, index: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """Distances to the members; links between components are kept."""
        both, n = self.similarity(query, members, index), self.n[members]
        for j in np.flatnonzero(100 * both >= self.percent * (n + self.n[query] - both)).tolist():
            x, y = self.find(query), self.find(int(members[j]))
            if x != y:
                self.top[max(x, y)] = min(x, y)
                self.links.append((self.a[query], self.a[members[j]]))
        return 1 - both / (n + self.n[query] - both)

    def join(self, queries: np.ndarray, members: np.ndarray) -> None:
        """Compares each query with the members that the windows leave."""
        if not len(queries) or not len(members):
            return
        index = self.index(members)
        if len(queries) * len(members) > LEAF:
            pivots = queries[:: max(1, len(queries) // int(len(members) ** 0.5))]
            of_pivots = self.index(pivots)
            near = np.array([self.compare(int(p), members, index) for p in pivots])
            home = near.argmin(axis=0)
            rest = np.setdiff1d(queries, pivots)
            far = np.array([self.compare(int(q), pivots, of_pivots) for q in rest]).reshape(len(rest), len(pivots))
            cells = [np.flatnonzero(home == i) for i in range(len(pivots))]
            visits = [np.flatnonzero(far[:, i] <= near[i, cell].max() + self.eps) if len(cell) else np.zeros(0, int) for i, cell in enumerate(cells)]
            if sum(len(c) * len(v) for c, v in zip(cells, visits, strict=True)) < 0.7 * len(rest) * len(members):
                for cell, visit in zip(cells, visits, strict=True):
                    self.join(rest[visit], members[cell])
                return
            queries = rest
        for q in queries.tolist():
            window = np.abs(self.d[members] - self.d[q]) <= self.eps
            if any(self.find(q) != self.find(int(x)) for x in members[window]):
                self.compare(q, members, index)


def _joined(table: pa.Table, percent: int) -> pa.Table:
    region = _Region(table, percent)
    outer, resident = (np.array(table.column(c).to_pylist(), bool) for c in ("outer", "resident"))
    region.join(np.flatnonzero(outer), np.flatnonzero(resident))
    return pa.table({"a": pa.array([a for a, _ in region.links], pa.int64()), "b": pa.array([b for _, b in region.links], pa.int64())})


# the operator ----------------------------------------------------------------------------------------------------


def join(docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = SHINGLE, percent: int = PERCENT, region: int = REGION) -> DataFrame:
    """Per row of ``docs``: ``id``, ``n_shingles`` and ``component_id``, the smallest id reachable by links."""
    marks = settle(measured(docs, id, text, size))
    points = marks.filter("n > 0 AND id IS NOT NULL")
    total = points.agg(F.sum("n")).first()[0] or 0
    firsts = settle(points.groupBy("a").agg(F.min(F.struct("id", "version", "n")).alias("f")).select("a", "f.*"))
    near = firsts.join(shared(docs.filter(F.col(id).isNotNull()), text, size, total).hint("merge"), "a").filter(100 * F.col("m") >= percent * F.col("n"))
    sets = settle(point_sets(docs, near, id, text, size))
    found = settle(met(settle(anchors(sets, percent)), sets))
    links = settle(found.filter(alike(percent)).select("a", F.col("c").alias("b")))
    apart = blocks(settle(boundary(found, components(links), percent)), percent, region)
    apart = apart.hint("merge").join(sets.select("a", "s").hint("merge"), "a")
    more = apart.groupBy("c", "ring", "slot").applyInArrow(lambda t: _joined(t, percent), "a long, b long")
    labels = components(settle(links.union(more)))
    linked = labels.join(firsts.select("a", "id").hint("merge"), "a")
    smallest = linked.groupBy("label").agg(F.min("id").alias("smallest"))
    of_point = firsts.join(labels.join(smallest.hint("merge"), "label").select("a", "smallest").hint("merge"), "a", "left").select("a", F.coalesce("smallest", "id").alias("component_id"))
    linked = (F.col("n") > 0) & F.col("id").isNotNull()
    return marks.join(of_point.hint("merge"), "a", "left").select(F.col("id").alias(id), F.col("n").alias("n_shingles"), F.when(linked, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
