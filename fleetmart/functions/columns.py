"""Null-tolerant numeric and conditional Column helpers. Nothing here raises under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import add, or_
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(c: str | Column) -> Column:
    """Double value, NULL where the text is not a number."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom, NULL instead of an error or an infinity when bottom is zero."""
    return F.try_divide(top, bottom)


def zero_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def total(parts: Iterable[Column]) -> Column:
    """Sum that is NULL as soon as one part is NULL."""
    return reduce(add, parts)


def known_total(parts: Iterable[Column]) -> Column:
    """Sum that treats missing parts as zero."""
    return reduce(add, [zero_if_null(p) for p in parts])


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(or_, conditions)


def any_missing(columns: Iterable[Column]) -> Column:
    return any_of([c.isNull() for c in columns])


def clip_low(c: Column, low: float = 0.0) -> Column:
    """max(c, low), keeping NULL for NULL."""
    return F.when(c.isNotNull(), F.greatest(c, F.lit(low)))


def first_match(cases: Iterable[tuple[str, Column]], default: str = "") -> Column:
    """Label of the first condition that holds; a NULL condition does not hold."""
    hits = [F.when(cond, F.lit(label)) for label, cond in cases]
    return F.coalesce(*hits, F.lit(default))


def weighted_mean(x: Column, weight: Column) -> Column:
    """Aggregate: sum(x*w) / sum(w), NULL for zero weight."""
    return F.try_divide(F.sum(x * weight), F.sum(weight))


def pounds_to_kg(value: Column, in_pounds: Column) -> Column:
    # fixed value: conversion factor
    return F.when(in_pounds, value * F.lit(0.454)).otherwise(value)


def duration_band(hours: Column) -> Column:
    """SHORT up to 3 h, MID up to 6 h, otherwise (also when unknown) LONG."""
    return first_match([("SHORT", hours <= 3), ("MID", hours <= 6)], "LONG")


def literal_map(values: Mapping, cast: str | None = None) -> Column:
    """Driver-side dictionary as a map literal, for small config tables."""
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    m = F.create_map(*pairs)
    return m if cast is None else m.cast(cast)


def look_up(values: Mapping, key: Column) -> Column:
    """Value of ``key`` in a small dictionary, NULL when it is not listed."""
    return F.try_element_at(literal_map(values), key) if values else F.lit(None)


def reverse_look_up(groups: Mapping[str, Iterable[str]], key: Column) -> Column:
    """Name of the group that lists ``key``; the first group wins."""
    flat: dict[str, str] = {}
    for name, members in groups.items():
        for m in members:
            flat.setdefault(m, name)
    return look_up(flat, key)


def identity(*parts: Column) -> Column:
    """Hash of a key. Each part goes with its length, a NULL as a mark of its own, so different keys never give the same
    text, whatever separators they hold."""
    texts = [p.cast("string") for p in parts]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)
