"""Best-fit packing of tokenised documents into sequences by a grouping genetic algorithm.

Pieces are dealt at random into groups of about ``GROUP`` pieces; each group is packed by ``ISLANDS`` populations, one
task each. A solution is a list of bins. Crossover injects the best-filled bins of one parent into the other, takes
out the bins that hold a piece a second time, and best-fits the displaced pieces again. After each epoch every island
passes its best solution to the next one (a shuffle by group and island). Mutation gathers the room of all bins in a
few that it opens, by exchanges of one piece for one or two, and packs these anew. A population stops at the lower bound. The fullest bins of the best solution
of a group are final; what lies in the others is dealt into new, larger-than-needed groups for one more round, so that
few sequences stay open however many groups there were.

Defined results: a null or empty text is the end token alone; equal rows are packed separately; an empty table gives
an empty table; a text longer than a sequence is cut from its end into full pieces, the first may be shorter; further
columns don't matter.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.settle import settle

CAPACITY = 1024
END = 2
GROUP = 3000
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 3
POPULATION = 4
MUTATIONS = 4
POOL = 4  # bins that the local search opens

# tokens ---------------------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=1)
def _added(vocabulary_path: str) -> dict[str, int]:
    """The added tokens of a vocabulary of the tokenizers library with their ids."""
    with open(vocabulary_path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
        raise ValueError(f"added tokens of {vocabulary_path} that aren't matched as they stand")
    return {t["content"]: t["id"] for t in tokens}


class Encoder:
    """Token ids of texts as little-endian 32-bit numbers: those of the tokenizers library with the vocabulary's JSON.
    The JSON's added tokens are found in a text first and have their own ids; what lies between them is encoded by itself."""

    def __init__(self, ranks_path: str, pattern: str):
        self.encode = _encoding(ranks_path, pattern).encode_ordinary
        added = _added(re.sub(r"\.tiktoken$", ".json", ranks_path))
        self.added = {token: np.array([number], "<u4").tobytes() for token, number in added.items()}
        self._split = re.compile(f"({'|'.join(sorted(map(re.escape, added), key=len, reverse=True))})").split  # longest first

    def ids(self, text: str) -> bytes:
        if not any(token in text for token in self.added):
            return self._between(text)
        return b"".join([self.added[t] if n % 2 else self._between(t) for n, t in enumerate(self._split(text))])

    def _between(self, text: str) -> bytes:
        return np.array(self.encode(text), "<u4").tobytes()


PIECES = "piece int, start long, length int, ids_crc32 long, slot long, ids binary"


def pieces(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k.tiktoken", with_ids: bool = False) -> DataFrame:
    """Each document's tokens with the end token, cut into pieces of at most ``capacity``: ``piece``, ``start`` (tokens
    before it), ``length``, ``ids_crc32``, a running ``slot`` that tells equal rows apart, and ``ids`` if asked for."""
    schema = T.StructType([T.StructField("doc", docs.schema[id].dataType), *T._parse_datatype_string(PIECES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        encoder = Encoder(public_tokenizers.path(tokenizer), public_tokenizers.PATTERN)
        end, slot = np.array([END], "<u4").tobytes(), TaskContext.get().partitionId() << 40
        for batch in batches:
            out = []
            for row, t in enumerate(batch.column(1)):
                data = encoder.ids(t.as_py() or "") + end
                total = len(data) // 4
                at = 0
                cuts = [*range(total % capacity or capacity, total, capacity), total]
                for k, stop in enumerate(cuts):
                    own = data[4 * at : 4 * stop]
                    out.append((row, k, at, stop - at, zlib.crc32(own), slot, own if with_ids else None))
                    at, slot = stop, slot + 1
            kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array([o[c + 1] for o in out], k) for c, k in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([o[0] for o in out], pa.int32())), *columns], names=schema.names)

    return docs.select(id, text).mapInArrow(run, schema)


# the genetic algorithm ------------------------------------------------------------------------------------------

Bins = list[list[int]]


class BestFit:
    """Puts pieces into the open bin that they fill best. Bins are found by their free space in a sorted list."""

    def __init__(self, sizes: list[int], capacity: int, bins: Bins):
        self.sizes, self.capacity, self.bins = sizes, capacity, bins
        self.free = sorted((capacity - sum(sizes[i] for i in b), n) for n, b in enumerate(bins))

    def put(self, item: int) -> None:
        size = self.sizes[item]
        at = bisect_left(self.free, (size, -1))
        if at < len(self.free):
            room, n = self.free.pop(at)
            self.bins[n].append(item)
        else:
            room, n = self.capacity, len(self.bins)
            self.bins.append([item])
        if room > size:
            insort(self.free, (room - size, n))


def packed(sizes: list[int], capacity: int, items: list[int]) -> Bins:
    fit = BestFit(sizes, capacity, [])
    for i in items:
        fit.put(i)
    return fit.bins


def fitness(sizes: list[int], capacity: int, bins: Bins) -> tuple[int, float]:
    """Fewer bins, then fuller ones (the sum of squared fills favours full bins and leaves one empty)."""
    return len(bins), -sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(sizes: list[int], capacity: int, giver: Bins, taker: Bins, rng: np.random.Generator) -> Bins:
    """Whole well-filled bins of the giver go into the taker; bins that hold one of their pieces are taken apart, and
    what is displaced is best-fitted, largest first."""
    fills = [sum(sizes[i] for i in b) for b in giver]
    best = sorted(range(len(giver)), key=lambda n: -fills[n])[: max(1, len(giver) * 2 // 3)]
    chosen = [giver[n] for n in best if rng.random() < 0.6]
    given = {i for b in chosen for i in b}
    kept = [b for b in taker if given.isdisjoint(b)]
    rest = [i for b in taker if not given.isdisjoint(b) for i in b if i not in given]
    fit = BestFit(sizes, capacity, [list(b) for b in chosen + kept])
    for i in sorted(rest, key=lambda i: -sizes[i]):
        fit.put(i)
    return fit.bins


def drained(sizes: list[int], capacity: int, bins: Bins, rng: np.random.Generator) -> Bins:
    """Local search of a child: the least filled bin and some without a piece of more than half a bin are emptied into a
    pool. Every other bin with room gives one piece for one or two of the pool's that fill it better, so all room gathers
    in the pool, whose light pieces are then packed anew."""
    fills = [sum(sizes[i] for i in b) for b in bins]
    last = min(range(len(bins)), key=fills.__getitem__)
    light = [n for n, b in enumerate(bins) if 2 * max(sizes[i] for i in b) <= capacity] or [last]
    pool = {last, *(light[int(k)] for k in rng.integers(0, len(light), POOL))}
    held = sorted((sizes[i], i) for n in pool for i in bins[n])
    bins = [list(b) for b in bins]
    for n in sorted((n for n in range(len(bins)) if n not in pool and fills[n] < capacity), key=fills.__getitem__):
        while held and (room := capacity - fills[n]):
            k = bisect_left(held, (room + 1, -1)) - 1
            best = (held[k][0], None, (k,)) if k >= 0 else (0, None, ())
            for i in bins[n]:
                if best[0] == room:
                    break
                own = sizes[i]
                if 2 * own > capacity:
                    continue
                k = bisect_left(held, (own + room + 1, -1)) - 1
                if k >= 0 and held[k][0] - own > best[0]:
                    best = (held[k][0] - own, i, (k,))
                lo, hi = 0, min(k, len(held) - 1)
                while lo < hi:  # two pieces whose sum comes nearest from below
                    gain = held[lo][0] + held[hi][0] - own
                    if gain > room:
                        hi -= 1
                    else:
                        if gain > best[0]:
                            best = (gain, i, (lo, hi))
                        lo += 1
            gain, out, given = best
            if not gain:
                break
            for k in reversed(given):
                bins[n].append(held.pop(k)[1])
            if out is not None:
                bins[n].remove(out)
                insort(held, (sizes[out], out))
            fills[n] += gain
    return [b for n, b in enumerate(bins) if n not in pool] + packed(sizes, capacity, [i for _, i in reversed(held)])


def evolve(sizes: list[int], capacity: int, found: list[Bins], seed: int, generations: int = GENERATIONS, population: int = POPULATION) -> Bins:
    """The best solution of one island after some generations, beginning with ``found``."""
    rng = np.random.default_rng(seed)
    people = list(found)
    orders = [sorted(range(len(sizes)), key=lambda i: -sizes[i])]
    while len(people) < population:
        if orders:
            order = orders.pop()
        else:  # about descending
            order = np.argsort(-(np.array(sizes) * rng.uniform(0.9, 1.1, len(sizes))), kind="stable").tolist()
        people.append(packed(sizes, capacity, order))
    rank = lambda p: fitness(sizes, capacity, p)
    least = -(-sum(sizes) // capacity)
    people.sort(key=rank)
    for _ in range(generations):
        if len(people[0]) == least:  # no solution has fewer
            break
        a, b = rng.choice(len(people), 2, replace=False).tolist()
        child = drained(sizes, capacity, crossover(sizes, capacity, people[min(a, b)], people[max(a, b)], rng), rng)
        people[-1] = min(people[-1], child, key=rank)
        people.sort(key=rank)
        for _ in range(MUTATIONS):
            people[0] = min(people[0], drained(sizes, capacity, people[0], rng), key=rank)
    return people[0]


# islands --------------------------------------------------------------------------------------------------------

ROW = "grp long, island int, slot long, length int, bin int"


def _island(capacity: int, epoch: int):
    """From the pieces of a group on one island, with the bin of each in the solutions that came along (null: none
    yet), to the pieces with their bins in the island's best solution."""

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        grp, island = key[0].as_py(), key[1].as_py()
        slots, lengths = rows.column("slot").to_pylist(), rows.column("length").to_pylist()
        order = sorted(set(zip(slots, lengths, strict=True)))
        number = {s: i for i, (s, _) in enumerate(order)}
        brought: dict[int, dict[int, list[int]]] = {}
        for s, origin, b in zip(slots, rows.column("origin").to_pylist(), rows.column("bin").to_pylist(), strict=True):
            if b is not None:
                brought.setdefault(origin, {}).setdefault(b, []).append(number[s])
        found = [list(brought[o].values()) for o in sorted(brought)]
        best = evolve([n for _, n in order], capacity, found, seed=(grp * 31 + island) * 31 + epoch)
        place = {i: n for n, b in enumerate(best) for i in b}
        return pa.table({
            "grp": pa.array([grp] * len(order), pa.int64()), "island": pa.array([island] * len(order), pa.int32()),
            "slot": pa.array([s for s, _ in order], pa.int64()), "length": pa.array([n for _, n in order], pa.int32()),
            "bin": pa.array([place[i] for i in range(len(order))], pa.int32()),
        })

    return run


def grouped(items: DataFrame, groups: int, capacity: int, islands: int, epochs: int) -> DataFrame:
    """(slot, length) with ``grp`` and ``bin``: each group's best solution over all islands."""
    dealt = items.withColumn("grp", F.pmod(F.xxhash64("slot", F.lit(groups)), F.lit(groups)))
    state = dealt.withColumn("island", F.explode(F.array(*map(F.lit, range(islands))))).select("grp", "island", "slot", "length", F.col("island").alias("origin"), F.lit(None).cast("int").alias("bin"))
    for epoch in range(epochs):
        if epoch:  # each island keeps its best and gets that of the one before
            own = state.withColumn("origin", F.col("island"))
            state = own.unionByName(own.withColumn("island", (F.col("island") + 1) % islands)) if islands > 1 else own
        state = settle(state.groupBy("grp", "island").applyInArrow(_island(capacity, epoch), ROW))
    fills = state.groupBy("grp", "island", "bin").agg(F.sum("length").alias("fill")).groupBy("grp", "island").agg(F.count(F.lit(1)).alias("bins"), F.sum(F.col("fill") * F.col("fill")).alias("squares"))
    best = fills.groupBy("grp").agg(F.min(F.struct("bins", -F.col("squares"), "island")).alias("b")).select("grp", F.col("b.island").alias("island"))
    return state.join(best, ["grp", "island"]).select("grp", "bin", "slot", "length")


def assigned(items: DataFrame, capacity: int = CAPACITY, group: int = GROUP, islands: int = ISLANDS, epochs: int = EPOCHS) -> DataFrame:
    """(slot, length) of pieces shorter than a sequence, with ``sequence_id`` and ``offset``."""
    result, levels, fresh = None, 0, items
    while True:
        n = fresh.count()
        groups = max(1, n // group)
        bins = settle(grouped(fresh, groups, capacity, islands, epochs))
        if groups > 1:  # bins that are not nearly full are opened again
            fills = bins.groupBy("grp", "bin").agg(F.sum("length").alias("fill"))
            final = fills.filter(F.col("fill") >= capacity - capacity // 64).select("grp", "bin")
            done, rest = bins.join(final, ["grp", "bin"]), bins.join(final, ["grp", "bin"], "left_anti")
        else:
            done, rest = bins, None
        last = rest is None or (left := rest.count()) == 0 or left > 0.7 * n
        if last:  # also if groups no longer get better by being dealt anew
            done = bins
        placed = done.groupBy("grp", "bin").agg(F.sort_array(F.collect_list(F.struct("slot", "length"))).alias("held")).select(
            (F.shiftleft(F.lit(levels + 1).cast("long"), 56) + F.shiftleft(F.col("grp"), 20) + F.col("bin")).alias("sequence_id"),
            F.explode(F.transform("held", lambda x, i: F.struct(x["slot"].alias("slot"), F.aggregate(F.slice("held", 1, i), F.lit(0).cast("long"), lambda a, y: a + y["length"]).alias("offset")))).alias("p"),
        ).select("p.slot", "sequence_id", "p.offset")
        result = placed if result is None else result.union(placed)
        if last:
            return result
        fresh, levels = settle(rest.select("slot", "length")), levels + 1


def pack(docs: DataFrame, id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, tokenizer: str = "byte_bpe_50k.tiktoken", with_ids: bool = False) -> DataFrame:
    """Per piece: the document's id, ``piece``, ``start``, ``length``, ``ids_crc32``, its ``sequence_id`` and
    ``offset``; with ``with_ids`` also the ids themselves, as little-endian 32-bit numbers. A full piece is a
    sequence of its own."""
    cut = settle(pieces(docs, id, text, capacity, tokenizer, with_ids))
    placed = assigned(cut.filter(F.col("length") < capacity).select("slot", "length"), capacity)
    columns = [F.col("doc").alias(id), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32"] + ["ids"] * with_ids
    alone = cut.filter(F.col("length") == capacity).select(*columns, (-1 - F.col("slot")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    shared = cut.filter(F.col("length") < capacity).join(placed, "slot").select(*columns, "sequence_id", "offset")
    return alone.unionByName(shared)
