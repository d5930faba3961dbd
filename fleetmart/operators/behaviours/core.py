"""Frame shared by all behaviour calculators.

A behaviour states which columns it needs, why a row may be ineligible (in priority order), and its savings
arithmetic. The frame turns that into five columns ``<prefix>__net_savings, __success, __savings,
__best_case_savings, __reason`` (maritime ones also ``__succeeded_predicted``), built in a few projections:
no join, no shuffle, no Python per row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetmart.functions.columns import first_match
from fleetmart.operators.filters import exclusion_cases, require_rows
from fleetmart.schema import faulty


@dataclass
class Outcome:
    """What a behaviour returns. ``savings`` (default: net) counts only on success; ``best`` sees success and savings.
    ``side`` holds further result columns, {name: value}; one with an input's name takes its place."""

    reasons: Sequence[tuple[str, Column]]
    net: Column
    success: Column
    savings: Column | None = None
    best: Callable[[Column, Column], Column] | Column | None = None
    net_if_eligible: bool = False
    side: Mapping[str, Column] = field(default_factory=dict)


class Sheet:
    """Working columns of one behaviour, added stage by stage so that no expression is expanded twice."""

    def __init__(self, df: DataFrame, prefix: str):
        self.df, self.prefix = df, prefix
        self.inputs = frozenset(df.columns)

    def has(self, name: str) -> bool:
        return name in self.inputs

    def text(self, name: str) -> Column:
        return F.col(name) if self.has(name) else F.lit(None).cast("string")

    def num(self, name: str, default: float | None = None) -> Column:
        read = f"try_cast(`{name}` AS DOUBLE)" if self.has(name) else "CAST(NULL AS DOUBLE)"
        return F.expr(read if default is None else f"coalesce({read}, {float(default)}D)")

    def nums(self, pattern: str, n: int, default: float | None = None) -> list[Column]:
        """Numbered inputs: ``pattern`` holds ``#`` where 1..n goes."""
        return [self.num(pattern.replace("#", str(i)), default) for i in range(1, n + 1)]

    def let(self, **columns: Column) -> list[Column]:
        """Add working columns; returns references in the order given."""
        named = {f"_{self.prefix}_{k}": v for k, v in columns.items()}
        self.df = self.df.withColumns(named)
        return [F.col(n) for n in named]

    def missing(self, names: Sequence[str]) -> tuple[str, Column]:
        absent = " OR ".join(f"`{n}` IS NULL" for n in names if self.has(n))
        return faulty("MISSING_REQUIRED_VALUES"), F.expr(absent if all(map(self.has, names)) else "true")


@dataclass(frozen=True)
class Behaviour:
    name: str
    prefix: str
    needs: tuple[str, ...]
    rule: Callable[..., Outcome]
    predicted: bool = False
    side: tuple[str, ...] = ()
    defaults: Mapping[str, object] = field(default_factory=dict)


BEHAVIOURS: dict[str, Behaviour] = {}


def behaviour(name: str, prefix: str, needs: Sequence[str], predicted: bool = False, side: Sequence[str] = (), **defaults):
    """Register ``rule(sheet, **options) -> Outcome`` under a name; ``side`` names the side columns that it gives,
    ``defaults`` are its options."""

    def register(rule):
        BEHAVIOURS[name] = Behaviour(name, prefix, tuple(needs), rule, predicted, tuple(side), defaults)
        return rule

    return register


def _results(prefix: str, predicted: bool, net, success, savings, best, reason) -> dict[str, Column]:
    out = {
        f"{prefix}__net_savings": net,
        f"{prefix}__success": success,
        f"{prefix}__savings": savings,
        f"{prefix}__best_case_savings": best,
        f"{prefix}__reason": reason,
    }
    if predicted:
        out[f"{prefix}__succeeded_predicted"] = F.lit(None).cast("boolean")
    return out


def calculate(df: DataFrame, name: str, exclusions: Sequence[Mapping] = (), prefix: str | None = None, **options) -> DataFrame:
    """Add the result columns of one behaviour.

    A required column that is absent makes the whole behaviour constant. Configured exclusions come before
    every other reason and zero all figures; other reasons only prevent success.
    """
    b = BEHAVIOURS[name]
    prefix = prefix or b.prefix
    original = list(df.columns)
    zero = F.lit(0.0)
    if [c for c in b.needs if c not in original]:
        gone = _results(prefix, b.predicted, zero, F.lit(False), zero, zero, F.lit(faulty("MISSING_REQUIRED_VALUES")))
        return df.withColumns(gone | {c: F.lit(None).cast("double") for c in b.side if c not in original})

    sheet = Sheet(df, prefix)
    o = b.rule(sheet, **{**b.defaults, **options})
    cases = exclusion_cases(df, exclusions)
    out_of_scope = first_match(cases, "") if cases else F.lit("")
    (excluded,) = sheet.let(excluded=out_of_scope)
    (reason,) = sheet.let(reason=F.when(excluded != "", excluded).otherwise(first_match(o.reasons)))
    (success,) = sheet.let(success=F.coalesce((reason == "") & o.success, F.lit(False)))
    net = F.when(reason == "", o.net).otherwise(zero) if o.net_if_eligible else F.when(excluded == "", o.net).otherwise(zero)
    gained = F.coalesce(F.when(success, o.net if o.savings is None else o.savings), zero)
    net, savings = sheet.let(net=net, savings=gained)
    best = savings if o.best is None else (o.best(success, savings) if callable(o.best) else o.best)
    best = F.coalesce(F.when(excluded == "", best), zero)
    done = _results(prefix, b.predicted, net, success, savings, best, reason) | dict(o.side)
    return sheet.df.select(*[F.col(f"`{c}`") for c in original if c not in done], *[c.alias(n) for n, c in done.items()])


def qualified(prefixes: Sequence[str]) -> Column:
    """True when no calculated behaviour has a reason."""
    ok = F.lit(True)
    for p in prefixes:
        ok = ok & (F.coalesce(F.col(f"{p}__reason"), F.lit("")) == "")
    return ok


def run(
    df: DataFrame, names: Sequence[str], filters: Mapping[str, Sequence[Mapping]] | None = None, positive: str | None = "voyage_time_hs",
    options: Mapping[str, Mapping] | None = None, watch: Observation | None = None, must_have_rows: bool = False,
) -> DataFrame:
    """All configured behaviours, then the ``qualified`` flag.

    Rows without a positive ``positive`` column are not events and are left out; ``must_have_rows`` stops the run
    when none remain. Non-qualified rows are counted through ``watch`` while the result is computed, not
    by an extra job.
    """
    if positive is not None:
        df = df.filter(F.col(positive).try_cast("double") > 0)
    if must_have_rows:
        require_rows(df, f"{positive} > 0")
    for n in names:
        df = calculate(df, n, (filters or {}).get(n, ()), **(options or {}).get(n, {}))
    df = df.withColumn("qualified", qualified([BEHAVIOURS[n].prefix for n in names]))
    if watch is not None:
        df = df.observe(watch, F.count_if(~F.col("qualified")).alias("non_qualified"), F.count(F.lit(1)).alias("events"))
    return df
