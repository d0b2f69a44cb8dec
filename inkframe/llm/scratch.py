"""Intermediate tables in the folder that all executors share.

The folder is ``spark.checkpoint.dir`` of the session. Only where that is unset and the master is local (tests, a laptop) a
temporary folder is made; on a cluster an unset folder is an error, as executors would each write to their own disk. Lineage is cut by writing a table here and reading it again, so a
lost executor costs only the tasks that ran on it.
"""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..ship import ensure_shipped

_OWN: list[str] = []
#: Rows of an Arrow batch, unless the session sets its own number: texts are long, and a batch is held in both processes.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, BATCH_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """URI of the shared folder, without a trailing slash."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if not _OWN:
            _OWN.append("file://" + tempfile.mkdtemp(prefix="inkframe-"))
        found = _OWN[0]
    return found.rstrip("/") if "://" in found else "file://" + found.rstrip("/")


def drop_all(spark: SparkSession) -> None:
    """Delete the tables of all runs in the shared folder; to be called when no result of theirs will be read again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/inkframe")
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


class Scratch:
    """The tables of one run of one operator, each in a folder of its own."""

    def __init__(self, spark: SparkSession, name: str):
        ensure_shipped(spark)
        small_batches(spark)
        self.spark = spark
        self.base = f"{shared_dir(spark)}/inkframe/{name}-{uuid.uuid4().hex}"

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        """Write the table and return it as read from disk."""
        df.write.mode("overwrite").parquet(self.path(table))
        return self.spark.read.schema(df.schema).parquet(self.path(table))

    def release(self) -> None:
        """Let Spark delete the shuffle files of finished jobs: it does so when the driver has collected what stood for them. What Python lets go
        of reaches the JVM a little later, so that a second round finds more."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.5)

    def drop(self, *tables: str) -> None:
        """Delete tables that nothing will read again."""
        jvm = self.spark._jvm
        for table in tables:
            at = jvm.org.apache.hadoop.fs.Path(self.path(table))
            at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)
