"""Prefix trie of conversations by depth-band rollup.

Each distinct sequence of first turns is a node; a node is named by its smallest member and its depth. The nodes of a
conversation are found by running hashes over its turns, so the trie is one grouped count of hashes.

Totals over subtrees take bands of ``height`` depths. A node adds its own figures to its ancestors inside its band
only, so it makes at most ``height`` rows. Then the first nodes of the bands, with the totals of their bands, are a
trie of their own, whose depth is smaller by the height: the same rollup completes them, again in bands. Completed
totals go to the ancestors inside the band above, at most ``height`` of them. Rounds grow with the logarithm of the
depth, and no node makes a row for each ancestor.

The identifiers of the conversations that end at a node are hashed as one sorted list: sorted ranges of rows become
pieces of text of a bounded size, and the pieces of a node are hashed one after the other, never held together.

Defined results: turns stand in ascending order (null first; ties by role, then text); a null role or text is empty; rows without a
conversation are left out; an empty table has no nodes, not even a root; equal conversations share all nodes; further
columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.settle import settle

HEIGHT = 4
PIECE = 1 << 20
KEPT = 6  # a rebuilt conversation takes fewer turns than this from its first one


def turns(rows: DataFrame, id: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, d, p, q, chars): the turns of each conversation numbered from 1, two hashes and the length of each."""
    rows = rows.select(F.col(id).alias("conv"), F.col(order).alias("at"), *(F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role, "role"), (text, "text")))).filter("conv IS NOT NULL")
    number = F.row_number().over(Window.partitionBy("conv").orderBy(F.asc_nulls_first("at"), "role", "text"))
    return rows.select("conv", number.cast("long").alias("d"), F.xxhash64("role", "text").alias("p"), F.xxhash64(F.lit(1), "text", "role").alias("q"), F.length("text").cast("long").alias("chars"))


def rebuilt(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members of the conversations branched off the first of their hundred: the first h turns of
    conversation c - c % 100, then c's own turns after its first h, where h is the CRC of the decimal c modulo 6."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % KEPT
    members = settle(numbered.select("conv").distinct().withColumns({"h": h, "first": F.col("conv") - F.col("conv") % 100}))
    numbered = settle(numbered)
    donors = numbered.filter((F.col("d") < KEPT) & (F.col("conv") % 100 == 0)).withColumnRenamed("conv", "first")
    given = donors.hint("merge").join(members.hint("merge"), "first").filter("d <= h").select("conv", "d", "p", "q", "chars")
    kept = members.hint("merge").join(donors.groupBy("first").agg(F.max("d").alias("held")), "first", "left").select("conv", "h", F.least("h", F.coalesce("held", F.lit(0))).alias("held"))
    own = numbered.hint("merge").join(kept.hint("merge"), "conv").filter("d > h").select("conv", (F.col("d") - F.col("h") + F.col("held")).alias("d"), "p", "q", "chars")
    return given.union(own), members.select("conv")


def rollup(paths: DataFrame, own: DataFrame, sums: list[str], height: int = HEIGHT) -> DataFrame:
    """(conv, i, sums): the figures of ``own`` summed over subtrees. ``paths`` has for every conversation and index i
    (0, 1, ...) the conversation that names the node there; ``own`` has the figures of the nodes."""
    if height < 2:
        raise ValueError("a band has two depths at least")
    over = Window.partitionBy("conv").orderBy("i").rowsBetween(-height, -1)
    above = settle(paths.withColumn("above", F.collect_list("owner").over(over)).filter("conv = owner").drop("owner"))
    deepest = above.agg(F.max("i")).first()[0] or 0

    def given(rows: DataFrame, n) -> DataFrame:
        """The figures of ``rows`` for each of their n nearest ancestors."""
        at = rows.select("i", *sums, n.alias("_up"), F.posexplode(F.slice("above", F.size("above") - n + 1, n)).alias("_at", "conv"))
        return at.select("conv", (F.col("i") - F.col("_up") + F.col("_at")).alias("i"), *sums)

    total = lambda parts: reduce(DataFrame.union, parts).groupBy("conv", "i").agg(*(F.sum(s).alias(s) for s in sums))
    inside = (F.col("i") % height).cast("int")
    own = own.select("conv", "i", *sums)
    banded = settle(total([own, given(above.hint("merge").join(own.hint("merge"), ["conv", "i"]).filter(inside > 0), inside)]))
    if deepest < height:
        return banded
    firsts = lambda df: df.filter(F.col("i") % height == 0).withColumn("i", F.floor(F.col("i") / height))
    complete = rollup(firsts(paths), firsts(banded), sums, height).withColumn("i", F.col("i") * height)
    below = above.filter(F.col("i") > 0).hint("merge").join(complete.hint("merge"), ["conv", "i"])
    return total([banded, given(below, F.lit(height))])


# digests of members -----------------------------------------------------------------------------------------------


def _pieces(batches: Iterator[pa.RecordBatch], limit: int, schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Sorted (owner, d, conv) rows as pieces (owner, d, first conv, joined)."""
    key, first, held, size, out = None, None, [], 0, []

    def end() -> None:
        if held:
            out.append((key[0], key[1], first, ",".join(held)))

    kinds: list[pa.DataType] = []
    for batch in batches:
        kinds = [batch.column(0).type, pa.int64(), batch.column(2).type, pa.string()]
        for owner, d, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (owner, d) != key or size > limit:
                end()
                key, first, held, size = (owner, d), conv, [], 0
            held.append(str(conv))
            size += len(held[-1]) + 1
        if sum(len(x[3]) for x in out) > limit:
            yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], k) for c, k in enumerate(kinds)], names=schema.names)
            out.clear()
    end()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], k) for c, k in enumerate(kinds)], names=schema.names)


def _hashed(batches: Iterator[pa.RecordBatch], schema: T.StructType) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as (owner, d, sha)."""
    key, sha, kind = None, None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([key[0]], kind), pa.array([key[1]], pa.int64()), pa.array([sha.hexdigest()])], names=schema.names)
    for batch in batches:
        done, kind = [], batch.column(0).type
        for owner, d, _, joined in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (owner, d) != key:
                if key:
                    done.append(row())
                key, sha = (owner, d), hashlib.sha256(joined.encode())
            else:
                sha.update(b"," + joined.encode())
        if done:
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
    if key:
        yield row()


def digests(rows: DataFrame, limit: int = PIECE) -> DataFrame:
    """(owner, d, sha): the SHA-256 of the ascending, comma-joined ``conv`` of each (owner, d). ``rows`` is a stored table."""
    kind = rows.schema["conv"].dataType
    pieces = T.StructType([T.StructField("owner", kind), T.StructField("d", T.LongType()), T.StructField("first", kind), T.StructField("joined", T.StringType())])
    done = T.StructType([T.StructField("owner", kind), T.StructField("d", T.LongType()), T.StructField("sha", T.StringType())])
    ordered = rows.select("owner", "d", "conv").repartitionByRange("owner", "d", "conv").sortWithinPartitions("owner", "d", "conv")
    joined = ordered.mapInArrow(lambda it: _pieces(it, limit, pieces), pieces)
    return joined.repartition("owner", "d").sortWithinPartitions("owner", "d", "first").mapInArrow(lambda it: _hashed(it, done), done)


# the operator -----------------------------------------------------------------------------------------------------


def nodes(rows: DataFrame, members: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Per node of the trie of ``rows`` (as :func:`turns` gives them) and ``members`` (conv): ``conv_id``, ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    ordered = Window.partitionBy("conv").orderBy("d")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, 0)
    paths = settle(
        rows.select(
            "conv", "d", F.bit_xor(F.xxhash64("d", "p", "q")).over(so_far).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "q", "d", "p")).over(so_far).alias("y"),
            "chars", F.lead("d").over(ordered).isNull().alias("last"),
        )
    )
    grouped = paths.groupBy("d", "x", "y").agg(F.min("conv").alias("owner"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.count_if("last").alias("ends"))
    paths = settle(paths.select("conv", "d", "x", "y", "last").hint("merge").join(grouped.hint("merge"), ["d", "x", "y"]).select("conv", "d", (F.col("d") - 1).alias("i"), "owner", "last", "n_convs", "chars", "ends"))

    kind = members.schema["conv"].dataType
    root, n_members = members.agg(F.min("conv"), F.count(F.lit(1))).first()
    root_name = F.lit(root).cast(kind)
    turnless = members.hint("merge").join(paths.select("conv").distinct().hint("merge"), "conv", "left_anti")
    parent = F.lag("owner").over(Window.partitionBy("conv").orderBy("i"))
    named = settle(paths.withColumn("parent", parent).filter("conv = owner").select("conv", "i", "d", "parent", "n_convs", (F.col("n_convs") == F.col("ends")).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens")))
    sums = ["n_leaves", "saved_tokens"]
    totals = rollup(paths.select("conv", "i", "owner"), named, sums, height)
    children = named.filter("i > 0").groupBy(F.col("parent").alias("conv"), (F.col("i") - 1).alias("i")).agg(F.count(F.lit(1)).alias("n_children"))
    below = totals.filter("i = 0").agg(F.count(F.lit(1)).alias("n_children"), *(F.sum(s).alias(s) for s in sums))

    ends = settle(paths.filter("last").select("owner", "d", "conv").unionByName(turnless.select(root_name.alias("owner"), F.lit(0).cast("long").alias("d"), "conv")))
    inner = named.drop(*sums).join(totals.hint("merge"), ["conv", "i"]).join(children.hint("merge"), ["conv", "i"], "left")
    inner = inner.select("conv", "d", F.coalesce("parent", root_name).alias("parent"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), *sums)
    top = below.filter(F.lit(root is not None)).select(
        root_name.alias("conv"), F.lit(0).cast("long").alias("d"), F.lit(None).cast(kind).alias("parent"), F.lit(n_members).cast("long").alias("n_convs"), "n_children",
        F.coalesce(F.when(F.col("n_children") > 0, F.col("n_leaves")), F.lit(1)).alias("n_leaves"), F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
    )
    found = inner.union(top).join(digests(ends).select(F.col("owner").alias("conv"), "d", "sha").hint("merge"), ["conv", "d"], "left")
    return found.select(
        F.col("conv").alias("conv_id"), F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def trie(rows: DataFrame, id: str = "conv_id", order: str = "turn", role: str = "role", text: str = "text", height: int = HEIGHT) -> DataFrame:
    """The nodes of a table of turns as it is."""
    numbered = turns(rows, id, order, role, text)
    return nodes(numbered, settle(numbered.select("conv").distinct()), height)
