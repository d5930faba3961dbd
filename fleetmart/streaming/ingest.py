"""Incremental ingest as a stream of file micro-batches.

The file source's checkpoint replaces the hand-kept watermark: each trigger takes the files that are new since the
last one, at most ``MICRO_BATCH`` at a time, and stops when none are left. Batches are written under their own
id, so a batch that is replayed after a failure replaces what it wrote before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from fleetmart import schema as S
from fleetmart.functions.strings import decode_path, strip_scheme
from fleetmart.operators.filters import bad_files, quarantine_split
from fleetmart.sources.files import MICRO_BATCH


def file_stream(spark: SparkSession, directory: str, schema: T.StructType, fmt: str = "csv", **options) -> DataFrame:
    """Rows of new files with their file columns; corrupt records are kept in their own column."""
    if S.CORRUPT_COLUMN not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField(S.CORRUPT_COLUMN, T.StringType())])
    base = {"header": True, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.CORRUPT_COLUMN, "maxFilesPerTrigger": MICRO_BATCH}
    raw = spark.readStream.format(fmt).schema(schema).options(**{**base, **options}).load(directory)
    return raw.withColumns(
        {
            "file_path": strip_scheme(decode_path(F.col("_metadata.file_path"))),
            "source_file_name": F.col("_metadata.file_name"),
            "file_modified": F.col("_metadata.file_modification_time"),
        }
    )


def write_batch(batch: DataFrame, batch_id: int, out: str) -> None:
    """Clean rows, quarantined rows and file statuses of one micro-batch."""
    kept = batch.persist()
    try:
        clean, corrupt = quarantine_split(kept)
        clean.drop(S.CORRUPT_COLUMN).write.mode("overwrite").parquet(f"{out}/clean/batch={batch_id}")
        corrupt.write.mode("overwrite").parquet(f"{out}/corrupted/batch={batch_id}")
        bad = bad_files(kept, F.col(S.CORRUPT_COLUMN).isNotNull()).withColumn("_bad", F.lit(True))
        files = kept.groupBy("file_path", "file_modified").agg(F.count(F.lit(1)).alias("rows")).join(bad, "file_path", "left")
        status = F.when(F.col("_bad"), F.lit(S.CORRUPTED)).otherwise(F.lit(S.INGESTED))
        files.withColumn("status", status).drop("_bad").write.mode("overwrite").parquet(f"{out}/ledger/batch={batch_id}")
    finally:
        kept.unpersist()


def run_available(stream: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Ingest everything that is there now, in micro-batches, then stop."""
    return (
        stream.writeStream.foreachBatch(lambda df, i: write_batch(df, i, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def once_per_delivery(stream: DataFrame, keys: list[str], ts: str, lateness: str = "1 day") -> DataFrame:
    """Drop repeats of (keys, time) that arrive within the lateness; a newer time counts as a new delivery."""
    return stream.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([*keys, ts])


def daily_figures(hours: DataFrame, ship: str, ts: str, figures: dict[str, Column], lateness: str | None = "6 hours") -> DataFrame:
    """Day totals of an hourly stream, emitted when a day can no longer change. No ``lateness`` where the stream
    already carries a watermark on ``ts``."""
    day = F.window(F.col(ts), "1 day")
    timed = hours.withWatermark(ts, lateness) if lateness else hours
    out = timed.groupBy(F.col(ship), day).agg(*[c.alias(n) for n, c in figures.items()])
    return out.withColumn("report_date", F.to_date("window.start")).drop("window")
