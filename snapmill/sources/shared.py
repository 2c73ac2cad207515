"""A folder that every executor can reach, for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the session's ``spark.checkpoint.dir``, removed when Python exits.

    A local session without that setting uses its warehouse. On a cluster that may be a folder of
    the driver's own disk, so there the setting is needed.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        base = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/snapmill-{purpose}-{uuid.uuid4().hex}"
    atexit.register(remove_folder, spark, path)
    return path


def _in_hadoop(spark: SparkSession, path: str):
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, wherever Spark keeps it."""
    folder, files = _in_hadoop(spark, path)
    return files.exists(folder)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it. Once the session has ended only a local one can go."""
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        if path.startswith(("/", "file:/")):
            shutil.rmtree(path.removeprefix("file:"), ignore_errors=True)
        return
    folder, files = _in_hadoop(spark, path)
    files.delete(folder, True)
