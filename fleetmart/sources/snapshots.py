"""Local copies of shared tables, refreshed by load.

A copy keeps the loads of a table that its ledger has finished, each in a folder of its own, and versions that list them.
A refresh copies the loads that the copy lacks and then publishes a version; until then readers see the one
before, and afterwards the new one, never a mix. Loads that the ledger no longer names leave the next version.

Defined results: a refresh that finds nothing new copies nothing and publishes nothing; two refreshes at once end with one
version that has every load once; a copy that was never refreshed reads as None.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart.sources import sinks as K
from fleetmart.sources import versions as V


def copied(spark: SparkSession, copy: str, version: int | None = None) -> dict[int, str]:
    """{load: folder} of a version of the copy, the newest by default."""
    listed = V.read_version(spark, copy, V.newest(spark, copy) if version is None else version)
    return {r[K.LOAD]: r["folder"] for r in listed.collect()} if listed is not None else {}


def refresh(spark: SparkSession, table: str, ledger: str, copy: str) -> list[int]:
    """Bring a copy up to the newest version of the ledger; returns the loads that were copied."""
    for _ in range(V.ATTEMPTS):
        base = V.newest(spark, copy)
        have = copied(spark, copy, base)
        done = K.finished_loads(K.read_current(spark, ledger))
        folders = {n: f for n, f in K._load_folders(spark, table).items() if n in done}
        missing = sorted(set(folders) - set(have))
        if not missing and set(have) <= done:
            return []
        into = f"data-{uuid.uuid4().hex}"
        for n in missing:  # loads differ in their columns
            spark.read.parquet(folders[n]).write.parquet(f"{copy}/{into}/{K.LOAD}={n:08d}")
        listed = [(n, f) for n, f in have.items() if n in done] + [(n, f"{into}/{K.LOAD}={n:08d}") for n in missing]
        try:
            V.write_version(spark.createDataFrame(listed, f"{K.LOAD} long, folder string").coalesce(1), copy, base)
            return missing
        except V.Conflict:
            V.remove(spark, f"{copy}/{into}")
    raise V.Conflict(f"{copy} changed during each of {V.ATTEMPTS} attempts")


def read(spark: SparkSession, copy: str, order: Sequence[str] = (), limit: int | None = None) -> DataFrame | None:
    """The copy as of its newest version, or an ordered preview of it."""
    held = copied(spark, copy)
    if not held:
        return None
    parts = [spark.read.parquet(f"{copy}/{f}").withColumn(K.LOAD, F.lit(n).cast("long")) for n, f in sorted(held.items())]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p, allowMissingColumns=True)
    df = df.orderBy(*order) if order else df
    return df if limit is None else df.limit(limit)
