"""Declarative data-quality checks over whole tables.

A suite is a list of expectations plus the table's key. Row-level expectations become predicates inside one
projection; all metrics of a suite come from one aggregation. Missing values never fail a check (except the
not-null one): they are counted as missing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators.aggregates import duplicates
from fleetmart.operators.joins import fact_join
from fleetmart.operators.settle import settle


@dataclass(frozen=True)
class Expectation:
    function: str
    args: Mapping[str, object] = field(default_factory=dict)
    critical: bool = False

    @property
    def column(self) -> str:
        return str(self.args["column"])


@dataclass(frozen=True)
class Suite:
    table: str
    pk: Sequence[str]
    expectations: Sequence[Expectation]

    @classmethod
    def from_config(cls, table: Mapping) -> Suite:
        """From one entry of a ``tables`` list: name, pk, columns_dq_validations[{function, args, meta}]."""
        return cls(
            table["name"],
            list(table["pk"]),
            [
                Expectation(e["function"], dict(e.get("args") or {}), bool((e.get("meta") or {}).get("critical")))
                for e in table["columns_dq_validations"]
            ],
        )

    def columns(self) -> list[str]:
        return list(dict.fromkeys([*self.pk, *[e.column for e in self.expectations]]))


# Row checks: function name -> predicate that holds for a good value.
ROW_CHECKS: dict[str, Callable[..., Column]] = {}


def row_check(name: str):
    def register(build):
        ROW_CHECKS[name] = build
        return build

    return register


@row_check("expect_column_values_to_match_regex")
def _(c: Column, regex: str, **_) -> Column:
    return c.cast("string").rlike(regex)


@row_check("expect_column_values_to_be_between")
def _(c: Column, min_value=None, max_value=None, **_) -> Column:
    ok = F.lit(True)
    if min_value is not None:
        ok = ok & (c >= F.lit(min_value))
    if max_value is not None:
        ok = ok & (c <= F.lit(max_value))
    return ok


@row_check("expect_column_values_to_not_be_null")
def _(c: Column, **_) -> Column:
    return c.isNotNull()


@row_check("expect_column_values_to_be_in_set")
def _(c: Column, value_set: Sequence, **_) -> Column:
    return c.isin(list(value_set))


@row_check("expect_column_values_to_be_json_parseable")
def _(c: Column, **_) -> Column:
    return F.try_parse_json(c.cast("string")).isNotNull()


UNIQUE = "expect_column_values_to_be_unique"
OF_TYPE = "expect_column_values_to_be_of_type"
MEAN = "expect_column_mean_to_be_between"


def _flag(i: int) -> str:
    return f"_bad{i}"


def flagged(df: DataFrame, suite: Suite, repeated: bool = True) -> DataFrame:
    """Checked columns and key, plus one boolean per expectation: True where the row fails it.

    Uniqueness needs the repeated values: they are found by a count that combines on the map side and
    joined back with the size-checked, skew-safe join; without ``repeated`` they are left to the caller. Type and mean
    checks have no failing rows.
    """
    out = df.select(*suite.columns())
    for i, e in enumerate(suite.expectations):
        if e.function == UNIQUE and repeated:
            twice = duplicates(out, e.column).withColumn(_flag(i), F.lit(True))
            out = fact_join(out, twice, [e.column], "left", computed=True)
    flags = {}
    for i, e in enumerate(suite.expectations):
        if e.function == UNIQUE:
            flags[_flag(i)] = F.coalesce(F.col(_flag(i)), F.lit(False)) if repeated else F.lit(False)
        elif e.function in ROW_CHECKS:
            c = F.col(e.column)
            bad = ~ROW_CHECKS[e.function](c, **{k: v for k, v in e.args.items() if k != "column"})
            if e.function != "expect_column_values_to_not_be_null":
                bad = bad & c.isNotNull()
            flags[_flag(i)] = F.coalesce(bad, F.lit(False))
        elif e.function in (OF_TYPE, MEAN):
            flags[_flag(i)] = F.lit(False)
        else:
            raise KeyError(f"unknown expectation {e.function!r}")
    return out.withColumns(flags)


def metrics(df: DataFrame, suite: Suite, run_name: str, run_time: str) -> DataFrame:
    """One row per expectation: counts, percentages, success, run data. One pass over the table, and for each uniqueness
    check a grouped count of its column; no rows are joined."""
    types = dict(df.dtypes)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in enumerate(suite.expectations):
        aggs += [F.count_if(F.col(e.column).isNull()).alias(f"_miss{i}"), F.count_if(F.col(_flag(i))).alias(f"_fail{i}")]
        if e.function == MEAN:
            aggs.append(F.avg(e.column).alias(f"_mean{i}"))
    one = flagged(df, suite, repeated=False).agg(*aggs).withColumn("_one", F.lit(1))
    for i, e in enumerate(suite.expectations):
        if e.function == UNIQUE:
            times = df.filter(F.col(e.column).isNotNull()).groupBy(e.column).agg(F.count(F.lit(1)).alias("_n"))
            failed = times.agg(F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias(f"_fail{i}"))
            one = one.drop(f"_fail{i}").join(failed.withColumn("_one", F.lit(1)), "_one")  # one row each
    return report(one, suite, types, run_name, run_time)


def report(one: DataFrame, suite: Suite, types: Mapping[str, str], run_name: str, run_time: str) -> DataFrame:
    """The result rows from one row of figures: ``_n``, and for each expectation ``_miss<i>``, ``_fail<i>`` and, of means,
    ``_mean<i>``."""

    def row(i: int, e: Expectation) -> Column:
        missing, failed = F.col(f"_miss{i}"), F.col(f"_fail{i}")
        present = F.col("_n") if e.function == "expect_column_values_to_not_be_null" else F.col("_n") - missing
        observed = F.lit(None).cast("double")
        ok = failed == 0
        if e.function == MEAN:
            observed = F.col(f"_mean{i}")
            lo, hi = e.args.get("min_value"), e.args.get("max_value")
            ok = F.lit(True)
            if lo is not None:
                ok = ok & (observed >= F.lit(lo))
            if hi is not None:
                ok = ok & (observed <= F.lit(hi))
            ok = F.coalesce(ok, F.lit(False))
        elif e.function == OF_TYPE:
            ok = F.lit(types[e.column] == str(e.args.get("type", e.args.get("type_"))).lower())
        return F.struct(
            F.lit(e.column).alias("column"),
            F.lit(e.function).alias("expectation_type"),
            ok.alias("expectation_success"),
            F.lit(e.critical).alias("critical"),
            F.col("_n").alias("element_count"),
            missing.alias("missing_count"),
            failed.alias("unexpected_count"),
            F.coalesce(F.try_divide(failed * 100.0, present), F.lit(0.0)).alias("unexpected_percent"),
            observed.alias("observed_value"),
        )

    rows = one.select(F.explode(F.array(*[row(i, e) for i, e in enumerate(suite.expectations)])).alias("r")).select("r.*")
    return rows.withColumns(
        {
            "run_name": F.lit(run_name),
            "run_time": F.lit(run_time).cast("timestamp"),
            "table_name": F.lit(suite.table),
            "run_time_year": F.year(F.lit(run_time).cast("timestamp")),
            "run_time_month": F.month(F.lit(run_time).cast("timestamp")),
            "run_time_day": F.dayofmonth(F.lit(run_time).cast("timestamp")),
        }
    )


def summary(results: DataFrame) -> DataFrame:
    """Run statistics over the expectations: evaluated, passed, failed, percent."""
    passed = F.count_if(F.col("expectation_success"))
    return results.groupBy("run_name", "run_time", "table_name").agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        passed.alias("successful_expectations"),
        F.count_if(~F.col("expectation_success")).alias("unsuccessful_expectations"),
        (F.lit(100.0) * passed / F.count(F.lit(1))).alias("success_percent"),
        (F.count_if(~F.col("expectation_success")) == 0).alias("success"),
    )


def tag_rows(df: DataFrame, suite: Suite, run_name: str, run_success: Column | bool | None = None) -> DataFrame:
    """Every row with a ``dq_validations`` struct.

    A key fails as soon as one of its rows fails: the failing keys (with one boolean per expectation, so
    the state per key is fixed) are joined back null-safely. Failed checks are listed once each, by name.
    ``run_success`` is the run's outcome; by default it is whether no key failed.
    """
    names = [e.function for e in suite.expectations]
    marked = flagged(df, suite)
    any_bad = F.lit(False)
    for i in range(len(names)):
        any_bad = any_bad | F.col(_flag(i))
    # NULL keys take part in the join under a typed stand-in, hence the pair (is null, text)
    pk = {f"_pk{i}": F.struct(F.col(k).isNull(), F.coalesce(F.col(k).cast("string"), F.lit(""))) for i, k in enumerate(suite.pk)}
    failing = (
        marked.filter(any_bad)
        .groupBy(*[c.alias(n) for n, c in pk.items()])
        .agg(*[F.max(F.col(_flag(i))).alias(_flag(i)) for i in range(len(names))])
    )
    failing = settle(failing)
    joined = fact_join(df.withColumns(pk), failing, list(pk), "left")
    hits = F.array_compact(F.array(*[F.when(F.col(_flag(i)), F.lit(n)) for i, n in enumerate(names)]))
    details = F.transform(F.array_sort(F.array_distinct(hits)), lambda n: F.struct(n.alias("expectation_type")))
    ok = F.size(details) == 0
    if run_success is None:
        run_success = F.lit(failing.isEmpty())
    elif isinstance(run_success, bool):
        run_success = F.lit(run_success)
    tag = F.struct(
        F.lit(run_name).alias("run_name"), run_success.alias("run_success"), ok.alias("run_row_success"),
        details.alias("dq_failure_details"),
    ).cast(S.DQ_TAG)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], tag.alias("dq_validations"))


def failures(tagged: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per failed check of each tagged row."""
    return tagged.select(*keep, F.explode("dq_validations.dq_failure_details").alias("d")).select(*keep, "d.expectation_type")


class CriticalCheckFailed(RuntimeError):
    pass


def gate(results: DataFrame) -> DataFrame:
    """Stop the run when a critical expectation failed (reads the few result rows only)."""
    bad = [f"{r['expectation_type']}({r['column']})" for r in results.filter("critical and not expectation_success").collect()]
    if bad:
        raise CriticalCheckFailed(", ".join(bad))
    return results
