"""Quality metrics by load: what has been checked is not read again.

Each load leaves a state beside the table: one row of counts and sums, and for uniqueness checks the number of rows of every
value. States merge by addition, so the metrics of the whole table come from the states of its loads, and a run reads
only the loads that have none. Values that occur in two loads count as repeated, as they do in a full scan.

A state counts when its version of the store is published (:mod:`fleetmart.sources.versions`); a run that dies before
leaves folders that no version names. A store belongs to one suite: another one is refused, since its states mean
something else.

Defined results: an empty load has a state of zeros; a load that the table no longer has is left out of the metrics;
without any load there are no metrics; means are sums over counts, NULL without a value.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.operators import quality as Q
from fleetmart.sources import versions as V

LOADS = "load long, folder string, suite string, types string"


def _text(c: str) -> Column:
    """A value as text; -0.0 is 0.0, as in a grouping."""
    return F.when(F.col(c) == 0, F.lit(0).cast("string")).otherwise(F.col(c).cast("string"))


def counts(df: DataFrame, suite: Q.Suite) -> DataFrame:
    """One row of figures that add up over loads."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, e in enumerate(suite.expectations):
        aggs += [F.count_if(F.col(e.column).isNull()).alias(f"_miss{i}"), F.count_if(F.col(Q._flag(i))).alias(f"_fail{i}")]
        if e.function == Q.MEAN:
            aggs += [F.sum(F.col(e.column).cast("double")).alias(f"_sum{i}"), F.count(e.column).alias(f"_count{i}")]
    return Q.flagged(df, suite, repeated=False).agg(*aggs)


def values(df: DataFrame, suite: Q.Suite) -> DataFrame | None:
    """(i, value, n): how often each value of the columns of uniqueness checks occurs."""
    found = None
    for i, e in enumerate(suite.expectations):
        if e.function == Q.UNIQUE:
            numeric = dict(df.dtypes)[e.column] in ("float", "double")
            value = _text(e.column) if numeric else F.col(e.column).cast("string")
            own = df.filter(F.col(e.column).isNotNull()).groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("i"), "value", "n")
            found = own if found is None else found.union(own)
    return found


def _named(suite: Q.Suite) -> str:
    return json.dumps([[e.function, dict(e.args)] for e in suite.expectations], sort_keys=True, default=str)


def checked(spark: SparkSession, store: str) -> dict[int, tuple[str, str, str]]:
    """{load: (folder, suite, types)} of the newest version of a store."""
    df = V.read_version(spark, store, V.newest(spark, store))
    return {r["load"]: (r["folder"], r["suite"], r["types"]) for r in df.collect()} if df is not None else {}


def refresh(spark: SparkSession, store: str, suite: Q.Suite, loads: Mapping[int, Callable[[], DataFrame]]) -> list[int]:
    """Add the states of the loads that have none, reading only these; returns them."""
    name = _named(suite)
    for _ in range(V.ATTEMPTS):
        base = V.newest(spark, store)
        have = checked(spark, store)
        if any(other != name for _, other, _ in have.values()):
            raise ValueError(f"{store} holds the states of another suite")
        missing = sorted(set(loads) - set(have))
        if not missing:
            return []
        rows = [(n, *have[n]) for n in have]
        for n in missing:
            df, folder = loads[n](), f"state-{uuid.uuid4().hex}"
            counts(df, suite).write.parquet(f"{store}/{folder}/counts")
            if (listed := values(df, suite)) is not None:
                listed.write.parquet(f"{store}/{folder}/values")
            rows.append((n, folder, name, json.dumps(dict(df.dtypes))))
        try:
            V.write_version(spark.createDataFrame(rows, LOADS).coalesce(1), store, base)
            return missing
        except V.Conflict:
            continue  # another run has added states: look again
    raise V.Conflict(f"{store} changed during each of {V.ATTEMPTS} attempts")


def metrics(spark: SparkSession, store: str, suite: Q.Suite, loads: Mapping[int, Callable[[], DataFrame]], run_name: str, run_time: str) -> DataFrame | None:
    """The result rows of :func:`fleetmart.operators.quality.metrics` over all of ``loads``, from their states."""
    refresh(spark, store, suite, loads)
    have = {n: s for n, s in checked(spark, store).items() if n in loads}
    if not have:
        return None
    folders = [f"{store}/{folder}" for folder, _, _ in have.values()]
    total = spark.read.parquet(*[f"{f}/counts" for f in folders])
    one = total.agg(*[F.sum(c).alias(c) for c in total.columns]).withColumn("_one", F.lit(1))
    if any(e.function == Q.UNIQUE for e in suite.expectations):
        times = spark.read.parquet(*[f"{f}/values" for f in folders]).groupBy("i", "value").agg(F.sum("n").alias("n")).filter("n > 1")
        repeated = [F.coalesce(F.sum(F.when(F.col("i") == i, F.col("n"))), F.lit(0)).alias(f"_fail{i}") for i, e in enumerate(suite.expectations) if e.function == Q.UNIQUE]
        failed = times.agg(*repeated).withColumn("_one", F.lit(1))
        one = one.drop(*[c for c in failed.columns if c != "_one"]).join(failed, "_one")  # one row each
    means = {f"_mean{i}": F.try_divide(F.col(f"_sum{i}"), F.col(f"_count{i}")) for i, e in enumerate(suite.expectations) if e.function == Q.MEAN}
    types = {c: t for _, _, text in have.values() for c, t in json.loads(text).items()}
    return Q.report(one.withColumns(means) if means else one, suite, types, run_name, run_time)
