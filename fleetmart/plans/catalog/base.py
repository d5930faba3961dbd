"""Registry of the queries that exercise each operator on the driver's tables, each with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = Query(name, run, sql)
        return run

    return register


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A driver table; zone-less timestamps become timestamps once, here."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    ntz = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def shown(c: Column, digits: int = 4) -> Column:
    """Double rounded for output. The tiny shift keeps exact decimal ties on one side in any engine, so plain arithmetic
    does, which is ten times as fast as decimal rounding; the last term turns -0.0 into 0.0."""
    return F.rint((c.cast("double") + 1e-9) * 10.0**digits) / F.lit(10.0**digits) + F.lit(0.0)


def shown_sql(expr: str, digits: int = 4) -> str:
    r = f"round(CAST({expr} AS DOUBLE) + 1e-9, {digits})"
    return f"(CASE WHEN {r} = 0 THEN 0.0 ELSE {r} END)"


def stamp(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def stamp_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def day_text(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def day_sql(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d')"


def long(c: Column) -> Column:
    return c.cast("bigint")
