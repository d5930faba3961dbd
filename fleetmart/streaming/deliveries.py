"""Files that are delivered again, as a stream.

Spark's file source hands a path over once, whatever becomes of the file. Here the stream is made of announcements: a
listing of the landing folder, reduced to paths and times that no earlier announcement has, is appended to a table of small
files, and the stream reads that table. A stateful operator keeps the newest time of every path and lets a row pass only if
it is newer, so overlapping listings, several listers and replayed batches give each delivery once.

Defined results: a file that is rewritten with a newer time is a new delivery, one with an older or equal time is
none; of several times of a path in one batch the newest counts; an empty folder announces nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fleetmart.functions.strings import decode_path, strip_scheme
from fleetmart.operators.ledger import select_files
from fleetmart.operators.settle import settle
from fleetmart.sources.files import MICRO_BATCH, list_files
from fleetmart.sources.versions import exists
from fleetmart.streaming.ingest import write_batch

ANNOUNCED = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("file_modified", T.TimestampType()), T.StructField("size", T.LongType())])
_EVER = ("0001-01-02", "9999-12-31")


def announce(spark: SparkSession, directory: str, announcements: str, glob: str | None = None, pattern: str | None = None, min_size: int = 0) -> int:
    """Append the files of a folder that are new or newer than announced before; returns their number. No content is
    read. Announcements come in files of at most ``MICRO_BATCH`` rows, each a batch of the stream."""
    listed = select_files(list_files(spark, directory, glob=glob), pattern, min_size, *_EVER)
    listed = listed.select(F.col("filepath").alias("file_path"), F.col("last_modified").alias("file_modified"), "size")
    if exists(spark, announcements):
        known = spark.read.schema(ANNOUNCED).parquet(announcements).groupBy("file_path").agg(F.max("file_modified").alias("known"))
        listed = listed.join(known, "file_path", "left").filter(F.col("known").isNull() | (F.col("file_modified") > F.col("known"))).drop("known")
    fresh = settle(listed)
    found = fresh.count()
    if found:
        fresh.sort("file_modified", "file_path").write.mode("append").option("maxRecordsPerFile", MICRO_BATCH).parquet(announcements)
    return found


def _newer(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The newest row of a path, if it is newer than the state."""
    newest = None
    for batch in batches:
        row = batch.loc[[batch["file_modified"].idxmax()]]
        if newest is None or row["file_modified"].iloc[0] > newest["file_modified"].iloc[0]:
            newest = row
    at = int(newest["file_modified"].iloc[0].value) // 1000  # microseconds
    if not state.exists or at > state.get[0]:
        state.update((at,))
        yield newest


def deliveries(spark: SparkSession, announcements: str, files_per_trigger: int = 1) -> DataFrame:
    """The stream of new deliveries (file_path, file_modified, size). State: one number for each path."""
    rows = spark.readStream.schema(ANNOUNCED).option("maxFilesPerTrigger", files_per_trigger).parquet(announcements)
    return rows.groupBy("file_path").applyInPandasWithState(_newer, ANNOUNCED, "newest long", "append", GroupStateTimeout.NoTimeout)


def ingest(stream: DataFrame, read: Callable[[Sequence[str]], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Read what has been announced and not yet read, in micro-batches, then stop. ``read`` takes the paths of a batch (at
    most ``MICRO_BATCH`` of an announcement) and gives rows with ``_path`` and ``_name``, as the readers of
    :mod:`fleetmart.sources.files` do. A batch that is replayed takes the place of what it wrote before."""

    def batch(files: DataFrame, number: int) -> None:
        taken = settle(files)
        paths = [r["file_path"] for r in taken.select("file_path").distinct().orderBy("file_path").collect()]
        if paths:
            rows = read(paths).withColumn("file_path", strip_scheme(decode_path(F.col("_path")))).withColumnRenamed("_name", "source_file_name").drop("_path")
            write_batch(rows.join(F.broadcast(taken.select("file_path", "file_modified")), "file_path"), number, out)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
