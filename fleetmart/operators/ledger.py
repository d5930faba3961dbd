"""The file ledger: what is new, what is pending, and how statuses move on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetmart import schema as S
from fleetmart.operators.joins import unseen


def in_window(ts: Column, after: str, until: str) -> Column:
    """Half-open time window (after, until]; the same bounds everywhere."""
    return (ts > F.lit(after).cast("timestamp")) & (ts <= F.lit(until).cast("timestamp"))


def select_files(listing: DataFrame, pattern: str | None, min_size: int, after: str, until: str) -> DataFrame:
    """Files by name pattern, minimum size and modification window."""
    keep = (F.col("size") >= min_size) & in_window(F.col("last_modified"), after, until)
    if pattern is not None:
        keep = keep & F.col("filename").rlike(pattern)
    return listing.filter(keep)


def new_files(listing: DataFrame, ledger: DataFrame, fmt: str, after: str, until: str) -> DataFrame:
    """Listed files that the ledger does not hold as ingested or pending under the same path *and* time,
    so that a file delivered again with a newer time is taken again."""
    held = ledger.filter(
        (F.col("format") == fmt) & F.col("status").isin(S.INGESTED, S.PENDING) & in_window(F.col("last_modified"), after, until)
    )
    return unseen(listing, held, {"filepath": "filepath", "last_modified": "last_modified"})


def pending_files(ledger: DataFrame, fmt: str, after: str, until: str, pattern: str | None = None) -> DataFrame:
    """Files still to be read; the predicates reach the ledger's Parquet scan."""
    keep = (F.col("format") == fmt) & ~F.col("status").isin(S.INGESTED, S.ARCHIVED) & in_window(F.col("last_modified"), after, until)
    if pattern is not None:
        keep = keep & F.col("filename").rlike(pattern)
    return ledger.filter(keep)


def update_status(ledger: DataFrame, changes: DataFrame, on: tuple[str, ...] = ("filepath",)) -> DataFrame:
    """Ledger with new statuses (cut to 255 characters) applied; ``changes`` holds (keys..., status)."""
    fresh = changes.groupBy(*on).agg(F.max(F.substring("status", 1, S.STATUS_LENGTH)).alias("_status"))
    joined = ledger.join(fresh, list(on), "left")
    return joined.withColumn("status", F.coalesce("_status", "status")).select(*ledger.columns)


def status_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("status").agg(F.count(F.lit(1)).alias("files"))
