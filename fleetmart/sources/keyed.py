"""Keyed tables: an upsert rewrites only the files that hold keys of its updates.

Rows lie in folders by a hash of their key. A version of the table is its manifest: for each folder the hash partition, the
smallest and largest first key, and the number of rows. An upsert reads and rewrites the folders of its partitions
whose bounds its keys reach into; updates that reach into none are written beside them. The new manifest is the commit.

Several writers may upsert at once. Whoever publishes second looks at what the first one changed: if it lies in other
partitions, only the manifest is made again, otherwise the upsert is repeated on the new rows.

Defined results: NULL keys match each other; of several updates of a key the smallest by all other columns counts, on the
first write as well; columns of either side are kept, NULL where a row lacks them; an upsert of no rows changes nothing but may
add columns.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetmart.operators.settle import settle
from fleetmart.operators.vault import distinct_by_key
from fleetmart.sources import versions as V

PARTITIONS = 64
MERGE = 8  # folders of a partition from which they are rewritten into one

PART, FOLDER = "_part", "_folder"
MANIFEST = T.StructType(
    [
        T.StructField(PART, T.IntegerType()),  # -1: the table's own row
        T.StructField(FOLDER, T.StringType()),
        T.StructField("_lo", T.StringType()),  # both NULL: unknown, or NULL keys
        T.StructField("_hi", T.StringType()),
        T.StructField("_rows", T.LongType()),
        T.StructField("_of", T.IntegerType()),
        T.StructField("_schema", T.StringType()),
    ]
)


def merged(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows not in the updates, plus the updates; columns of either side, NULL where one lacks them. NULL keys
    match each other, and of several updates of a key the smallest by all other columns counts."""
    updates = distinct_by_key(updates, list(keys))
    given = updates.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [target[f"`{k}`"].eqNullSafe(given[f"_k{i}"]) for i, k in enumerate(keys)])
    return target.join(given, same, "left_anti").unionByName(updates, allowMissingColumns=True)


def part_of(keys: Sequence[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(partitions)).cast("int")


def is_manifest(df: DataFrame) -> bool:
    return df.columns == MANIFEST.names


def manifest(spark: SparkSession, path: str, version: int) -> list:
    """The rows of a version's manifest: one for each folder, as many as the table has files."""
    df = V.read_version(spark, path, version)
    return df.collect() if df is not None and is_manifest(df) else []


def rows_of(spark: SparkSession, path: str, held: Sequence, schema: T.StructType) -> DataFrame:
    """The rows in the folders of manifest rows."""
    folders = [f"{path}/{r[FOLDER]}" for r in held if r[PART] >= 0]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame | None:
    """A version of a table (the newest by default), with or without a manifest."""
    version = V.newest(spark, path) if version is None else version
    df = V.read_version(spark, path, version)
    if df is None or not is_manifest(df):
        return df
    held = df.collect()
    return rows_of(spark, path, held, _schema(held))


def _schema(held: Sequence) -> T.StructType:
    return T.StructType.fromJson(json.loads(next(r["_schema"] for r in held if r[PART] < 0)))


def _grown(old: T.StructType, new: T.StructType) -> T.StructType:
    """Columns of both, all of them nullable."""
    fields = [*old.fields, *(f for f in new.fields if f.name not in old.names)]
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields])


def _identity(row) -> tuple:
    return row[PART], row[FOLDER], row["_schema"]


def _reached(spark: SparkSession, held: Sequence, staged: DataFrame, key: str) -> tuple[set[int], set[str]]:
    """Partitions that updates lie in, and the folders there that may hold one of their keys. One row for each partition and
    folder reaches the driver."""
    k = F.col(f"`{key}`")
    given = staged.groupBy(PART).agg(F.min(k).alias("lo"), F.max(k).alias("hi"))
    parts = {r[PART] for r in given.select(PART).collect()}
    files = spark.createDataFrame([tuple(r) for r in held if r[PART] in parts], MANIFEST)
    kind = staged.schema[key].dataType
    meets = F.col("_lo").isNull() | ((F.col("_lo").cast(kind) <= F.col("hi")) & (F.col("_hi").cast(kind) >= F.col("lo")))
    reached = {r[FOLDER] for r in files.join(F.broadcast(given), PART).filter(meets).select(FOLDER).collect()}
    many = {p for p in parts if sum(r[PART] == p for r in held) >= MERGE}
    return parts, reached | {r[FOLDER] for r in held if r[PART] in many}


def _written(rows: DataFrame, path: str, keys: Sequence[str], partitions: int) -> list[tuple]:
    """Manifest rows of a new data folder. The bounds come from a scan of the key column of what was written."""
    data = f"data-{uuid.uuid4().hex}"
    rows.withColumn(PART, part_of(keys, partitions)).repartition(PART).sortWithinPartitions(PART, *[f"`{k}`" for k in keys]).write.partitionBy(PART).parquet(f"{path}/{data}")
    k = F.col(f"`{keys[0]}`")
    known = F.count(k) == F.count(F.lit(1))
    schema = T.StructType([*rows.schema.fields, T.StructField(PART, T.IntegerType())])
    bounds = rows.sparkSession.read.schema(schema).parquet(f"{path}/{data}").groupBy(PART).agg(
        F.when(known, F.min(k).cast("string")).alias("lo"), F.when(known, F.max(k).cast("string")).alias("hi"), F.count(F.lit(1)).alias("n")
    )
    return [(r[PART], f"{data}/{PART}={r[PART]}", r["lo"], r["hi"], r["n"], None, None) for r in bounds.collect()]


def upsert(updates: DataFrame, path: str, keys: Sequence[str], partitions: int = PARTITIONS) -> int:
    """Update matching rows, insert the others; returns the version. Repeating it with the same updates gives the same
    rows. ``partitions`` counts for a new table: choose it so that a partition's rows fit a task."""
    spark, keys = updates.sparkSession, list(keys)
    staged = settle(updates)
    for _ in range(V.ATTEMPTS):
        base = V.newest(spark, path)
        held = manifest(spark, path, base)
        legacy = V.read_version(spark, path, base) if base and not held else None  # a table that was written whole
        own = next((r for r in held if r[PART] < 0), None)
        old = _schema(held) if own else legacy.schema if legacy is not None else staged.schema
        of, schema = own["_of"] if own else partitions, _grown(old, staged.schema)
        fresh = distinct_by_key(staged.select(*[F.col(f"`{f.name}`").cast(schema[f.name].dataType).alias(f.name) for f in staged.schema]), keys)
        fresh = settle(fresh.withColumn(PART, part_of(keys, of)))
        parts, reached = _reached(spark, held, fresh, keys[0])
        before = legacy if legacy is not None else rows_of(spark, path, [r for r in held if r[FOLDER] in reached], old)
        out = merged(before, fresh.drop(PART), keys)
        added = _written(out.select(*[F.col(f"`{f.name}`") if f.name in out.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]), path, keys, of)
        while True:
            kept = [tuple(r) for r in held if r[PART] >= 0 and r[FOLDER] not in reached]
            table = (-1, "", None, None, None, of, schema.json())
            try:
                return V.write_version(spark.createDataFrame([table, *kept, *added], MANIFEST).coalesce(1), path, base)
            except V.Conflict:
                now = V.newest(spark, path)
                later = manifest(spark, path, now)
                moved = {part for part, *_ in {*map(_identity, held)} ^ {*map(_identity, later)}}
                if own is None or moved & (parts | {-1}):
                    V.remove(spark, f"{path}/{added[0][1].split('/')[0]}") if added else None
                    break  # another writer has changed what this upsert has read
                base, held = now, later
    raise V.Conflict(f"{path} changed during each of {V.ATTEMPTS} attempts")


def vacuum(spark: SparkSession, path: str, keep: int = 2, older_than_s: float = 24 * 3600) -> list[str]:
    """Remove all but the newest ``keep`` versions, and the data folders that none of these names and that are older than
    any running upsert; returns the folders."""
    V.drop_old(spark, path, keep)
    used = {r[FOLDER].split("/")[0] for n in V.versions(spark, path) for r in manifest(spark, path, n)}
    fs, p = V.hadoop(spark, path)
    gone = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if (name.startswith("data-") and name not in used or name.startswith(V.ATTEMPT)) and st.getModificationTime() / 1000 <= time.time() - older_than_s:
            fs.delete(st.getPath(), True)
            gone.append(name)
    return sorted(gone)
