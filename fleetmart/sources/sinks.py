"""Writing tables: append with schema growth, upsert by new version, quarantine, publication.

Tables are Parquet folders. A table that is rewritten (upsert, ledger) keeps numbered versions
(:mod:`fleetmart.sources.versions`, :mod:`fleetmart.sources.keyed`); readers take the newest complete one, so a job that
dies half-way leaves the previous version in force, and several writers do not lose each other's changes.
"""

from __future__ import annotations

import random
import re
import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators import ledger as L
from fleetmart.operators.cluster import clustered
from fleetmart.operators.filters import bad_files, quarantine_split
from fleetmart.operators.project import columns_first
from fleetmart.operators.settle import settle
from fleetmart.operators.vault import tables as vault_tables
from fleetmart.sources import keyed
from fleetmart.sources.keyed import merged, upsert  # noqa: F401 - part of this module's interface
from fleetmart.sources.versions import Conflict, change, exists, hadoop, newest, versions, write_version  # noqa: F401


def append(df: DataFrame, path: str, sort_by: Sequence[str] = (), partition_by: Sequence[str] = ()) -> None:
    """Create or append. Leading sorted columns give narrow row-group statistics, which later scans skip by;
    columns new to the table simply appear (read with ``mergeSchema``)."""
    out = columns_first(df, sort_by)
    if sort_by:
        out = out.sortWithinPartitions(*[c for c in sort_by if c in df.columns])
    w = out.write.mode("append")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)


def append_by_day(df: DataFrame, path: str, ts: str, keys: Sequence[str] = ()) -> None:
    """Append partitioned by the day of a timestamp (a timestamp itself would give one folder per second).

    Rows are first brought together by day and a hash of the keys, so each day gets a few files and a busy
    day is still written by several tasks."""
    day = F.to_date(F.col(ts)).alias("event_day")
    spread = F.pmod(F.xxhash64(*[F.col(k) for k in keys or [ts]]), F.lit(16))
    df.withColumn("event_day", day).repartition(F.col("event_day"), spread).write.mode("append").partitionBy("event_day").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def export_single(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """All rows in one file. They are computed in parallel and pass through one writing task row by row, so its memory
    does not grow with them; a large result is better written as a table."""
    df.repartition(1).write.mode("overwrite").option("header", "true").format(fmt).save(path)


# versioned tables

def read_current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version of a table, None without any."""
    return keyed.read(spark, path)


# ingest results

LOAD = "load"  # ledger column and folder name: the load that brought a file in
LEASE_S = 24 * 3600.0  # a load of another driver that has not been committed for so long is given up

_BEGUN: dict[int, bool] = {}  # loads of this driver: whether they still run


def begin_load(version: int) -> int:
    """A number for a new load: later than all loads of the ledger, and not that of a load that begins elsewhere."""
    load = (version + 1) * 10**9 + random.SystemRandom().randrange(10**9)
    _BEGUN[load] = True
    return load


def end_load(load: int) -> None:
    _BEGUN[load] = False


def save_load(df: DataFrame, path: str, load: int, sort_by: Sequence[str] = ("source_file_name", "ingestion_datetime")) -> DataFrame:
    """Write clean files to the load's folder of ``path`` and corrupt ones to that of ``path_corrupted``, in place of what
    an unfinished attempt left there; returns (filepath, status) of the files that have rows.

    Nothing counts before the ledger is written: :func:`read_loads` and :func:`drop_unfinished` go by its load numbers.
    The parsed rows are staged first: a pruned text scan cannot tell corrupt records, and parsing is paid once.
    """
    staged = settle(df)
    clean, corrupt = quarantine_split(staged)
    for rows, base in ((clean.drop(S.CORRUPT_COLUMN), path), (corrupt, f"{path}_corrupted")):
        out = columns_first(rows, sort_by)
        overwrite(clustered(out, sort_by), f"{base}/{LOAD}={load:08d}")
    bad = bad_files(staged, F.col(S.CORRUPT_COLUMN).isNotNull()).withColumn("_bad", F.lit(True))
    seen = staged.select("file_path").distinct().join(bad, "file_path", "left")
    status = F.when(F.col("_bad"), F.lit(S.CORRUPTED)).otherwise(F.lit(S.INGESTED))
    return seen.select(F.col("file_path").alias("filepath"), status.alias("status"))


def save_ingest(df: DataFrame, path: str, ledger: DataFrame, load: int, sort_by: Sequence[str] = ("source_file_name", "ingestion_datetime")) -> DataFrame:
    """:func:`save_load`, and the ledger with the new statuses and the number of the load."""
    return stamped(ledger, save_load(df, path, load, sort_by), load)


def stamped(ledger: DataFrame, changes: DataFrame, load: int) -> DataFrame:
    """Ledger with the new statuses, and the load's number at the pending rows that got one."""
    if LOAD not in ledger.columns:
        ledger = ledger.withColumn(LOAD, F.lit(None).cast("bigint"))
    old = ledger.withColumn("_was", F.col("status"))
    new = L.update_status(old, changes)
    moved = ~F.col("_was").isin(S.INGESTED, S.ARCHIVED) & F.col("status").isin(S.INGESTED, S.CORRUPTED) & (~F.col("status").eqNullSafe(F.col("_was")))
    return new.withColumn(LOAD, F.when(moved, F.lit(load).cast("bigint")).otherwise(F.col(LOAD))).drop("_was")


def _load_folders(spark: SparkSession, path: str) -> dict[int, str]:
    fs, p = hadoop(spark, path)
    found = [st.getPath() for st in fs.listStatus(p)] if fs.exists(p) else []
    return {int(m.group(1)): f.toString() for f in found if (m := re.fullmatch(rf"{LOAD}=(\d+)", f.getName()))}


def finished_loads(ledger: DataFrame | None) -> set[int]:
    """Numbers of the loads that the ledger knows (one for each finished run)."""
    if ledger is None or LOAD not in ledger.columns:
        return set()
    return {r[0] for r in ledger.select(LOAD).filter(F.col(LOAD).isNotNull()).distinct().collect()}


def drop_load(spark: SparkSession, path: str, load: int) -> None:
    """Remove the folders of a load that is not to count."""
    for base in (path, f"{path}_corrupted"):
        if (folder := _load_folders(spark, base).get(load)) is not None:
            fs, p = hadoop(spark, folder)
            fs.delete(p, True)


def drop_unfinished(spark: SparkSession, path: str, ledger: DataFrame, lease_s: float = LEASE_S) -> None:
    """Remove what runs left that ended before their ledger was written: those of this driver at once, those of others
    when their lease is over. A load that still runs is left alone."""
    done = finished_loads(ledger)
    for base in (path, f"{path}_corrupted"):
        for load, folder in _load_folders(spark, base).items():
            fs, p = hadoop(spark, folder)
            if load in done or _BEGUN.get(load):
                continue
            if load in _BEGUN or fs.getFileStatus(p).getModificationTime() / 1000 <= time.time() - lease_s:
                fs.delete(p, True)


def read_loads(spark: SparkSession, path: str, ledger_path: str) -> DataFrame | None:
    """The rows of all finished loads of a table, each file once, whatever an interrupted run has left beside them."""
    done = finished_loads(read_current(spark, ledger_path))
    folders = [f for n, f in sorted(_load_folders(spark, path).items()) if n in done]
    return spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*folders) if folders else None


def failed(ledger: DataFrame, filepath: str, error: str) -> DataFrame:
    """Ledger with the error text as the status of one file."""
    return ledger.withColumn("status", F.when(F.col("filepath") == filepath, F.lit(error[: S.STATUS_LENGTH])).otherwise(F.col("status")))


# publication

def publish(events: DataFrame, layout: Mapping[str, Sequence[str]], base: str, keys: Mapping[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Write all hub, link and satellite tables.

    The event table is written once and the tables are projected from that copy: each reads only its own
    columns, and the merge and behaviour steps are not repeated per table.
    """
    spark = events.sparkSession
    overwrite(events, f"{base}/events")
    saved = spark.read.parquet(f"{base}/events")
    out = {}
    for name, t in vault_tables(saved, layout, keys).items():
        out[name] = f"{base}/{name}"
        overwrite(t, out[name])
    return out


def publish_bucketed(
    events: DataFrame, layout: Mapping[str, Sequence[str]], base: str, key: str, buckets: int, database: str = "default", keys: Mapping[str, Sequence[str]] | None = None
) -> dict[str, str]:
    """:func:`publish` as catalog tables that are bucketed and sorted by the event key where they have it: hub and satellites
    are then joined and grouped by it without any exchange. Returns {table: its name in the catalog}; another session
    finds them by :func:`attach_bucketed`."""
    spark = events.sparkSession
    overwrite(events, f"{base}/events")
    saved = spark.read.parquet(f"{base}/events")
    out = {}
    for name, t in vault_tables(saved, layout, keys).items():
        out[name] = f"{database}.{name}"
        w = t.write
        if key in t.columns:  # one file for each bucket
            w = t.repartition(buckets, F.col(f"`{key}`")).write.bucketBy(buckets, key).sortBy(key)
        w.mode("overwrite").format("parquet").option("path", f"{base}/{name}").saveAsTable(out[name])
    return out


def attach_bucketed(spark: SparkSession, base: str, names: Sequence[str], key: str, buckets: int, database: str = "default") -> dict[str, str]:
    """Make published tables known to a session whose catalog lacks them."""
    out = {}
    for name in names:
        out[name] = f"{database}.{name}"
        schema = spark.read.parquet(f"{base}/{name}").schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        clustered = f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS" if key in schema.names else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {out[name]} ({columns}) USING parquet {clustered} LOCATION '{base}/{name}'")
    return out
