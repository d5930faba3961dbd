"""Raw files to a typed-as-text table: the pending files of the ledger in one load, with per-file failure status.

A load is written to a folder of its own and counts from the moment that the ledger that names it is written. A run that
ends before leaves nothing that counts, and a later one removes it.

The streaming form (:mod:`fleetmart.streaming.ingest`) does the same from the file source's own checkpoint.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators import ledger as L
from fleetmart.operators.aggregates import watermark
from fleetmart.operators.filters import require_rows
from fleetmart.operators.joins import unseen
from fleetmart.operators.project import columns_first, sanitise_names, trim_names
from fleetmart.operators.settle import settle
from fleetmart.sources import files as Fs
from fleetmart.sources import sinks as K
from fleetmart.sources import versions as V

BEGINNING = "2010-01-01 17:21"  # fixed value: start that stands for "no custom window"
EVER = "0001-01-02"
CLUSTER_KEYS = ("source_file_name", "ingestion_datetime")


def load_window(ledger: DataFrame | None, fmt: str, mode: str, start: str = BEGINNING, until: str = "9999-12-31", late_files: bool = True) -> tuple[str, str]:
    """(after, until) of a load: a custom start as given; otherwise everything (``full``), or (``incremental``) what is
    newer than the ledger's newest file. With ``late_files`` an incremental load has no lower bound either: files that
    arrive with an older time are taken, and what the ledger knows is left out by path and time anyway."""
    if mode not in ("full", "incremental"):
        raise ValueError(f"load type {mode!r}")
    if start != BEGINNING:
        return start, until
    if mode == "full" or ledger is None or late_files:
        return EVER, until
    newest = watermark(ledger, fmt).select(F.date_format("start_from", "yyyy-MM-dd HH:mm")).first()[0]
    return newest or EVER, until


def reader(spark: SparkSession, fmt: str, **options) -> Callable[[Sequence[str]], DataFrame]:
    """Reading function for a format: csv (sep, header_line, skip_rows), json, xml (row_tag)."""
    read = {"csv": Fs.read_csv, "json": Fs.read_json, "xml": Fs.read_xml}[fmt]
    return lambda paths: read(spark, paths, **options)


def prepared(df: DataFrame, run_id: str, ingested_at: str) -> DataFrame:
    """File columns, clean names, and the clustering columns in front."""
    return columns_first(trim_names(sanitise_names(Fs.decorated(df, run_id, ingested_at))), CLUSTER_KEYS)


def faults(paths: Sequence[str], attempt: Callable[[Sequence[str]], None]) -> dict[str, str]:
    """Files that make an attempt fail, with their error text, found by halving."""
    try:
        attempt(paths)
    except Exception as e:  # noqa: BLE001 - its text becomes the status
        if len(paths) == 1:
            return {paths[0]: str(e)}
        half = len(paths) // 2
        return faults(paths[:half], attempt) | faults(paths[half:], attempt)
    return {}


#: conditions and causes of errors that lie in a file, not in the cluster
READING = ("FAILED_READ_FILE", "MALFORMED", "UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND", "INVALID_XML", "XML_ROW_TAG", "CANNOT_PARSE", "FAILED_PARSE", "NUM_COLUMNS_MISMATCH")
CAUSES = ("EOFException", "ZipException", "FileNotFoundException", "MalformedInputException", "not a Parquet file", "JsonParseException", "XMLStreamException")


def reading_error(e: Exception) -> bool:
    """Whether a file is at fault: then the others can still be read. A lost executor or a full disk is not such an error."""
    if isinstance(e, ValueError | AnalysisException):
        return True
    condition = (e.getCondition() or "") if isinstance(e, PySparkException) else ""
    return condition.startswith(READING) or any(c in str(e) for c in (*READING, *CAUSES))


def _load(spark, ledger: DataFrame, pending: DataFrame, paths: list[str], table_path: str, load: int, rows) -> DataFrame:
    """Write a load; (filepath, status) of every pending file, the faulty ones with their error text."""
    failed: dict[str, str] = {}
    try:
        found = K.save_load(rows(paths), table_path, load)
    except Exception as e:  # noqa: BLE001 - find the files at fault
        if not reading_error(e):
            raise
        failed = faults(paths, lambda group: rows(group).write.format("noop").mode("overwrite").save())
        good = [p for p in paths if p not in failed]
        # if every file can be read, it is the writing that fails: that is for the caller to see
        found = K.save_load(rows(good), table_path, load) if good else spark.createDataFrame([], "filepath string, status string")
    found = found.union(spark.createDataFrame(list(failed.items()), "filepath string, status string"))
    rest = unseen(pending, found, {"filepath": "filepath"}).select("filepath", F.lit(S.NO_ROWS).alias("status"))
    return settle(found.union(rest))


def _after(ledger: DataFrame, changes: DataFrame, load: int) -> DataFrame:
    """The ledger after a load. Files without a row keep an earlier delivery's status."""
    after = K.stamped(ledger, changes.filter(F.col("status") != S.NO_ROWS), load)
    empty = changes.filter(F.col("status") == S.NO_ROWS).select("filepath").distinct().withColumn("_empty", F.lit(True))
    status = F.when(F.col("_empty") & (F.col("status") == S.PENDING), F.lit(S.NO_ROWS)).otherwise(F.col("status"))
    return after.join(empty, "filepath", "left").withColumn("status", status).select(*after.columns)


def ingest(
    spark: SparkSession, ledger_path: str, fmt: str, table_path: str, run_id: str, ingested_at: str, read: Callable[[Sequence[str]], DataFrame],
    window: tuple[str, str] = ("0001-01-02", "9999-12-31"), pattern: str | None = None, strict: bool = False,
) -> int:
    """Ingest the pending files of a versioned ledger in one load; returns their number.

    The driver handles the paths that the reader needs. If the files can't be read together, those at fault are found
    by halving; they keep their error text as status, and the others are loaded. Files without a row get a status too.
    A corrupt file isn't read again until it is delivered anew. With ``strict``, a load without any clean row is an error
    (its statuses are kept).

    Several runs may work on a ledger at once. A load counts when its ledger version is published; if another run has
    published in between, and has settled none of this load's files, only the ledger is made again; otherwise
    the load is given up and the files that are still pending are loaded.
    """
    rows = lambda group: prepared(read(group), run_id, ingested_at)
    for _ in range(V.ATTEMPTS):
        base = K.newest(spark, ledger_path)
        ledger = V.read_version(spark, ledger_path, base)
        K.drop_unfinished(spark, table_path, ledger)
        pending = settle(L.pending_files(ledger, fmt, *window, pattern).filter(F.col("status") != S.CORRUPTED).select("filepath", "last_modified").distinct())
        paths = [r["filepath"] for r in pending.select("filepath").distinct().orderBy("filepath").collect()]
        if not paths:
            return 0
        load = K.begin_load(base)
        try:
            changes = _load(spark, ledger, pending, paths, table_path, load, rows)
            while True:
                try:
                    K.write_version(_after(ledger, changes, load), ledger_path, base)
                    break
                except K.Conflict:
                    base = K.newest(spark, ledger_path)
                    ledger = V.read_version(spark, ledger_path, base)
                    still = L.pending_files(ledger, fmt, *window, pattern).filter(F.col("status") != S.CORRUPTED)
                    if not unseen(pending, still, {"filepath": "filepath", "last_modified": "last_modified"}).isEmpty():
                        K.drop_load(spark, table_path, load)
                        raise
        except K.Conflict:
            continue
        finally:
            K.end_load(load)
        if strict:
            clean = K.read_loads(spark, table_path, ledger_path)
            require_rows(spark.range(0) if clean is None else clean.filter(F.col(K.LOAD) == load), f"load {load} of {fmt} files")
        return len(paths)
    raise K.Conflict(f"{ledger_path} changed during each of {V.ATTEMPTS} attempts")


def land_files(spark: SparkSession, directory: str, ledger_path: str, fmt: str, mode: str = "incremental", start: str = BEGINNING, until: str = "9999-12-31", pattern: str | None = None, min_size: int = 0) -> int:
    """Record new files of a directory in the versioned ledger; returns the version written. Of several runs at once each builds
    on what the others have recorded."""

    def build(known: DataFrame | None) -> DataFrame:
        known = spark.createDataFrame([], S.LEDGER) if known is None else known
        window = load_window(known, fmt, mode, start, until)
        fresh = Fs.land(spark, directory, known, fmt, *window, pattern=pattern, min_size=min_size)
        # a file that failed before comes back as pending, in place of its old row
        return K.merged(known, fresh, ["filepath", "last_modified"])

    return K.change(spark, ledger_path, build)
