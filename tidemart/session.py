"""Session settings and the folder that all executors share."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime settings only: all of them can be put on a session that already runs. Time zone and partitions are the
# operator's own choice.
RUNTIME = {
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys: the oversized partition is cut by map-output ranges at run time, so that
    # even identical copies of one row spread over many tasks.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streams merge the rows of a session before the shuffle, as partial aggregates do.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}
STATEFUL = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Off unless writing(): a DataFrame that ran under it and runs again finds its shuffles gone.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tune(spark: SparkSession) -> SparkSession:
    """Put the settings the operators count on onto a running session."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def build(master: str = "local[8]", name: str = "tidemart", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks."""
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.python.unix.domain.socket.enabled": "true",
        **RUNTIME,
        **extra,
    }
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder of the folder named in spark.checkpoint.dir, else of the warehouse: executors share both."""
    root = spark.conf.get("spark.checkpoint.dir", None) or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def folder(spark: SparkSession, path: str) -> tuple[object, object]:
    """A folder and the file system that has it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = folder(spark, path)
    return files.exists(at)


def remove_folder(spark: SparkSession, path: str) -> None:
    files, at = folder(spark, path)
    files.delete(at, True)


@contextlib.contextmanager
def writing(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)
