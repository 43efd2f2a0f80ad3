"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only where it is unset and the master is local,
    since the executors of a cluster would each write to a disk of their own."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("clausewise.folder", None)
    if not folder:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="clausewise-")
        spark.conf.set("clausewise.folder", folder)
    return folder.rstrip("/")


def fresh(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, removed when the session ends."""
    path = f"{shared_folder(spark)}/clausewise/{label}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return path


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Lower the bytes of an Arrow batch that the JVM sends to Python to ``limit``, for rows that hold whole texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m")) > limit:
        spark.conf.set(name, str(limit))
