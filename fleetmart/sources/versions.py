"""Tables as numbered versions, for any number of writers.

A version is a folder ``v00000001``, ``v00000002``, ... of Parquet files. It is written under another name and renamed to its number
without overwriting, so of two writers that have read the same version only one can publish the next; the other one
gets a :class:`Conflict`, reads again and repeats what depends on it. Readers take the newest complete version. A writer
that dies leaves a folder that no reader looks at.

The rename must not overwrite, which Hadoop's own file systems and local ones guarantee (streaming checkpoints need the same).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

ATTEMPT = "_attempt-"
ATTEMPTS = 20


class Conflict(Exception):
    """Another writer was faster."""


def hadoop(spark: SparkSession, path: str):
    """The file system that holds a path, and the path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    fs, p = hadoop(spark, path)
    fs.delete(p, True)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Renames a file or folder unless the target exists; whether it did."""
    jvm = spark._jvm
    src, dst = (jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs, _ = hadoop(spark, source)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(src).toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        context.rename(fs.makeQualified(src), fs.makeQualified(dst), options)
    except Py4JJavaError:
        if exists(spark, target):
            return False
        raise
    return True


def _numbered(spark: SparkSession, path: str) -> dict[int, bool]:
    """Numbers that are taken, and whether their version is complete."""
    fs, p = hadoop(spark, path)
    if not fs.exists(p):
        return {}
    names = {int(m.group(1)): st.getPath() for st in fs.listStatus(p) if (m := re.fullmatch(r"v(\d+)", st.getPath().getName()))}
    return {n: fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")) for n, folder in names.items()}


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, oldest first."""
    return sorted(n for n, done in _numbered(spark, path).items() if done)


def newest(spark: SparkSession, path: str) -> int:
    """Number of the newest complete version, 0 without any."""
    return max(versions(spark, path), default=0)


def folder(path: str, version: int) -> str:
    return f"{path}/v{version:08d}"


def read_version(spark: SparkSession, path: str, version: int) -> DataFrame | None:
    return spark.read.parquet(folder(path, version)) if version else None


def write_version(df: DataFrame, path: str, after: int | None = None) -> int:
    """Publish the next version. With ``after`` only if that is still the newest one, else :class:`Conflict`."""
    spark = df.sparkSession
    attempt = f"{path}/{ATTEMPT}{uuid.uuid4().hex}"
    df.write.parquet(attempt)
    for _ in range(ATTEMPTS):
        taken = _numbered(spark, path)
        last = max((n for n, done in taken.items() if done), default=0)
        n = max(taken, default=0) + 1  # an unfinished folder keeps its number
        if after is not None and last != after:
            break
        if rename_new(spark, attempt, folder(path, n)):
            return n
    remove(spark, attempt)
    raise Conflict(f"{path} has moved on from version {after}" if after is not None else f"no free version of {path} in {ATTEMPTS} attempts")


def change(spark: SparkSession, path: str, build: Callable[[DataFrame | None], DataFrame]) -> int:
    """Publish ``build`` of the newest version; again from the then newest one if another writer comes first."""
    for _ in range(ATTEMPTS):
        last = newest(spark, path)
        try:
            return write_version(build(read_version(spark, path, last)), path, last)
        except Conflict:
            continue
    raise Conflict(f"{path} changed during each of {ATTEMPTS} attempts")


def drop_old(spark: SparkSession, path: str, keep: int) -> None:
    """Remove all but the newest ``keep`` versions."""
    for n in versions(spark, path)[:-keep]:
        remove(spark, folder(path, n))
