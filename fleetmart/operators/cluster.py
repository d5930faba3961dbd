"""Clustering rows so that filters on any of several keys skip files.

Each key is cut into ``2**bits`` ranges of about equally many rows; the bits of a row's range numbers are interleaved
(Z-order), and rows are ranged over files by that number. A file then spans a small interval of every key, not only of the
first one, and its minimum and maximum let a scan pass it over.

Defined results: NULL comes before the smallest value; equal values of a key fall in one range; no key at all leaves the rows as they are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 5
SAMPLED = 10_000  # rows that the cuts are taken from; the cuts only decide where rows lie


def cuts(df: DataFrame, keys: Sequence[str], bits: int = BITS, sampled: int = SAMPLED) -> dict[str, list]:
    """For each key the values that cut it into ranges, from a sample of bounded size. ``df`` is a stored table: it is
    counted, and read once more for the sample."""
    total = df.count()
    share = min(1.0, 1.2 * sampled / max(total, 1))
    rows = (df if share >= 1 else df.sample(share, seed=1)).select(*[F.col(f"`{k}`") for k in keys]).limit(2 * sampled).collect()
    found = {}
    for i, k in enumerate(keys):
        values = sorted(r[i] for r in rows if r[i] is not None)
        parts = 1 << bits
        found[k] = sorted({values[n * len(values) // parts] for n in range(1, parts)}) if values else []
    return found


def range_number(key: Column, at: Sequence) -> Column:
    """How many of the ascending cuts are not above the key, by bisection: the expression's depth is the number of bits."""

    def bisect(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key >= F.lit(at[mid]), bisect(mid + 1, hi)).otherwise(bisect(lo, mid))

    return bisect(0, len(at))


def z_number(numbers: Sequence[Column], bits: int) -> Column:
    """Range numbers with their bits interleaved, the first key's above the second's and so on."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for i, n in enumerate(reversed(numbers)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(n.cast("long"), b).bitwiseAND(F.lit(1)), b * len(numbers) + i))
    return out


def clustered(df: DataFrame, keys: Sequence[str], files: int | None = None, bits: int = BITS, sampled: int = SAMPLED) -> DataFrame:
    """``df`` in ``files`` ranges of its Z-order over ``keys`` (by default as many as adaptive execution finds right), sorted
    by them inside; write it without any further exchange.
    Rows of one cell of all ranges stay together, so one key value with most rows makes one file."""
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df
    at = cuts(df, keys, bits, sampled)
    marked = df.withColumn("_z", z_number([range_number(F.col(f"`{k}`"), at[k]) for k in keys], bits))
    ranged = marked.repartitionByRange(files, "_z") if files else marked.repartitionByRange("_z")
    return ranged.sortWithinPartitions("_z", *[f"`{k}`" for k in keys]).drop("_z")
