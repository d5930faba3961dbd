"""Registries through which users add derived columns and behaviours by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Formula:
    field: str
    needs: tuple[str, ...]
    build: Callable[..., Column]
    domain: str


FORMULAS: dict[tuple[str, str], Formula] = {}
# A domain falls back to its parent, then to "any".
PARENTS: dict[str, str] = {}


def formula(field: str, needs: Iterable[str] = (), domain: str = "any"):
    """Register ``build(c, state) -> Column``; ``c(name)`` is an input column, NULL where it is absent."""

    def register(build):
        FORMULAS[(domain, field)] = Formula(field, tuple(needs), build, domain)
        return build

    return register


def find(field: str, domain: str) -> Formula:
    for d in (domain, PARENTS.get(domain, domain), "any"):
        if (d, field) in FORMULAS:
            return FORMULAS[(d, field)]
    raise KeyError(f"no formula for {field!r} in {domain!r}")


def in_dependency_order(chosen: Mapping[str, Formula]) -> list[list[str]]:
    """Waves of formulas: each wave needs only source columns and earlier waves."""
    left = {f: set(x.needs) & (set(chosen) - {f}) for f, x in chosen.items()}
    waves = []
    while left:
        ready = [f for f, needs in left.items() if not needs & set(left)]
        if not ready:
            raise ValueError(f"formulas depend on each other: {sorted(left)}")
        waves.append(ready)
        for f in ready:
            del left[f]
    return waves


WIDE = 24  # columns that one piece of generated code calculates


def with_columns(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """``withColumns``, where they are many in several steps that are compiled apart: the JVM leaves methods above 8000 bytes
    uncompiled, and the code of all steps is one method otherwise. Coalescing to more partitions than there are moves no row."""
    if len(new) <= WIDE:
        return df.withColumns(dict(new))
    old = df.columns
    held = {c: f"{c}__{i}_new" for i, c in enumerate(new)}  # every column reads the old values
    columns = [(held[c], x) for c, x in new.items()]
    for i in range(0, len(columns), WIDE):
        df = df.withColumns(dict(columns[i : i + WIDE])).coalesce(1 << 20)
    of = {c.lower(): c for c in new}
    kept = [F.col(f"`{held[of[c.lower()]]}`").alias(of[c.lower()]) if c.lower() in of else F.col(f"`{c}`") for c in old]
    return df.select(*kept, *[F.col(f"`{h}`").alias(c) for c, h in held.items() if c.lower() not in {o.lower() for o in old}])


def apply_formulas(df: DataFrame, fields: Iterable[str], domain: str, states: Mapping[str, Mapping] | None = None, types: Mapping[str, object] | None = None) -> DataFrame:
    """Add derived columns, one :func:`with_columns` per dependency wave."""
    states, types = states or {}, types or {}
    chosen = {f: find(f, domain) for f in fields}
    for wave in in_dependency_order(chosen):
        present = set(df.columns)

        def c(name: str, present=present) -> Column:
            return F.col(name) if name in present else F.lit(None)

        new = {}
        for f in wave:
            col = chosen[f].build(c, states.get(f, {}))
            new[f] = col.try_cast(types[f]) if f in types else col
        df = with_columns(df, new)
    return df
