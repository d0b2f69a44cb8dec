"""New folders that the driver and all executors share, and the disk that finished jobs hold."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import SparkSession


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name of its own below spark.checkpoint.dir. Only with a local master and that unset is it a temporary one; on a cluster an unset
    folder is an error."""
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="inkframe-")
    return f"{shared.rstrip('/')}/inkframe-base/{name}-{uuid.uuid4().hex}"


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs, which it does when the driver has collected what stood for them. What Python lets go of reaches the
    JVM a little later, so that a second round finds more."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)
