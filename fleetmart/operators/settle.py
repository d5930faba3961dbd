"""Intermediate tables: computed once, written to the cluster's shared scratch folder, read back.

Used where a computed table is needed several times (size check, hot-key spreading, the join itself). The copy is an
ordinary table: it survives lost executors, and its file size lets Spark itself decide whether to broadcast it.

One behaviour everywhere: the folder is the one named by ``spark.checkpoint.dir``; where that is unset it is
``_scratch`` below ``spark.sql.warehouse.dir``. On a cluster that default is refused if it is a folder of each machine's own
(``file:``), where executors would each write their part to another disk. Copies of an application lie in one folder,
which goes when the driver's process ends.
"""

from __future__ import annotations

import atexit
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

_FOLDERS: dict[str, SparkSession] = {}


def shared_default(warehouse: str, master: str) -> str:
    """The folder where none is named: below the warehouse, if driver and executors share that."""
    one_machine = master == "local" or master.startswith("local[")
    if not one_machine and urlsplit(warehouse).scheme in ("", "file"):
        raise RuntimeError(f"{warehouse} is local to each machine of {master}: name a shared folder in spark.checkpoint.dir")
    return f"{warehouse.rstrip('/')}/_scratch"


def scratch_dir(spark: SparkSession) -> str:
    """This application's folder in the shared scratch space."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    base = named or shared_default(spark.conf.get("spark.sql.warehouse.dir"), spark.sparkContext.master)
    folder = f"{base.rstrip('/')}/{spark.sparkContext.applicationId}"
    if folder not in _FOLDERS:
        _FOLDERS[folder] = spark
        atexit.register(_remove, folder)
    return folder


def _remove(folder: str) -> None:
    """Deletes the copies of this application through the file system that holds them."""
    try:
        jvm = _FOLDERS.pop(folder)._jvm
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
    except Exception:  # noqa: BLE001 - the gateway may be gone already; the cluster's own clean-up remains
        pass


def settle(df: DataFrame) -> DataFrame:
    """The same rows, read from a written copy."""
    path = f"{scratch_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
