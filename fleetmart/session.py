"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution does the run-time sizing: partition coalescing, hot-partition splitting in sort-merge
# joins, and switching to a broadcast join only after the real size of a side is known.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # the older form of timestamps has no minimum and maximum in the files, so scans could not skip by time
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # the JVM never compiles methods above 8000 bytes: better to leave such a stage to per-operator code
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # no call-site capture per Column call: plans with hundreds of expressions are built several times faster
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build(app: str = "fleetmart", master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with :data:`SETTINGS`; on a cluster leave ``master`` to spark-submit and size
    ``shuffle_partitions`` as roughly input bytes / 128 MB."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()
