"""Aggregations and pivots. All of them combine on the map side; no group is collected."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def watermark(ledger: DataFrame, fmt: str) -> DataFrame:
    """Newest and oldest modification time and file count of one format, in one pass.

    ``start_from`` is the newest time with the seconds cut off, where the next incremental load begins."""
    return ledger.filter(F.col("format") == fmt).agg(
        F.max("last_modified").alias("newest"),
        F.min("last_modified").alias("oldest"),
        F.count(F.lit(1)).alias("files"),
        F.date_trunc("minute", F.max("last_modified")).alias("start_from"),
    )


def pivot_sums(df: DataFrame, keys: Sequence[str], on: str, values: Sequence[str], measures: Mapping[str, str], totals: Mapping[str, str] | None = None) -> DataFrame:
    """Sums per pivot value plus row totals over *all* values, missing ones ignored.

    Columns are ``{value}_{name}`` for measures ({name: source}); totals are {output: source} and come
    first after the keys. The value list is declared, so no extra job runs to find it, and the whole
    pivot is one conditional aggregation.
    """
    totals = totals or {}
    cells = [
        F.sum(F.when(F.col(on) == v, F.col(src))).alias(f"{v}_{name}") for v in values for name, src in measures.items()
    ]
    return df.groupBy(*keys).agg(*[F.sum(src).alias(out) for out, src in totals.items()], *cells)


def pivot_pick(df: DataFrame, keys: Sequence[str], on: str, values: Sequence[object], measures: Mapping[str, str], order: Sequence[str]) -> DataFrame:
    """Value of each measure in the first row (by ``order``) of every pivot cell: ``{name}_{value}``."""
    rank = F.struct(*[F.col(c) for c in order])
    cells = [
        F.min_by(F.col(src), F.when((F.col(on) == v) & F.col(src).isNotNull(), rank)).alias(f"{name}_{v}")
        for name, src in measures.items()
        for v in values
    ]
    return df.groupBy(*keys).agg(*cells)


def latest_known(columns: Iterable[str], order: Sequence[str]) -> list[Column]:
    """Aggregates: last non-NULL value of each column by ``order``."""
    rank = F.struct(*[F.col(o) for o in order])
    return [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), rank)).alias(c) for c in columns]


def max_matching(df: DataFrame, keys: Sequence[str], pattern: str, numeric: bool = False) -> DataFrame:
    """Maximum, per key, of every column whose upper-cased name matches a pattern; with ``numeric`` of its numbers,
    so that "10" is more than "9" (what is no number counts as NULL)."""
    rx = re.compile(pattern)
    hit = [c for c in df.columns if rx.match(c.upper())]
    if not hit:
        raise ValueError(f"no column matches {pattern!r}")
    read = lambda c: F.col(f"`{c}`").try_cast("double") if numeric else F.col(f"`{c}`")
    return df.groupBy(*[F.col(k).alias(k.upper()) for k in keys]).agg(*[F.max(read(c)).alias(c.upper()) for c in hit])


# Name patterns of recorder clock and calendar columns.
CLOCK_NAMES = r"^(UTC|GMT)_(HRS|HR|HOUR|MIN|MINUTE|SECS|SEC)(_.*)?$"
CALENDAR_NAMES = (
    r"^(CAP CLOCK|DATE)\s*\(?\s*(DAY|MONTH|YEAR)\s*\)?|^(DAY|MONTH|YEAR)|^(NAVDATEDAY_|NAVDATEMONTH_|NAVDATEYEAR_).*$"
)


def recorder_start(df: DataFrame, file_column: str) -> DataFrame:
    """Per recorder file, the maximum of every clock and calendar column."""
    return max_matching(df, [file_column], f"(?:{CLOCK_NAMES})|(?:{CALENDAR_NAMES})", numeric=True)


def duplicates(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, counted on the map side."""
    c = F.col(column)
    return df.filter(c.isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).drop("_n")
