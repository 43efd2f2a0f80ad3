"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import functools
import os
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; callers may pass any other path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only where the setting is absent and the master is local (tests) is a temporary folder used, and
    the choice is kept in the session so that every operator of the session uses the same one.  On
    a cluster without the setting there is no folder that all see, and the call fails.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("clausewise.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="clausewise-")
        spark.conf.set("clausewise.checkpoint.dir", base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/clausewise/{label}-{uuid.uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut and the rows survive
    the loss of any executor.  The folder goes when the session ends, or by ``discard``."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    fs, at = _hadoop_path(spark, path)
    fs.deleteOnExit(at)
    out = spark.read.schema(df.schema).parquet(path)
    out._own_path = path
    return out


def discard(df: DataFrame) -> None:
    """Delete what ``materialize`` wrote for ``df``; only for tables that nothing reads any more."""
    fs, at = _hadoop_path(df.sparkSession, df._own_path)
    fs.delete(at, True)


def small_batches(spark: SparkSession, limit: int = 4 << 20) -> None:
    """Lower the bytes of an Arrow batch that the JVM sends to Python to ``limit``: Spark's 64 MB
    are held several times over (JVM, pipe, worker, results) by every task at once."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name, "64m")) > limit:
        spark.conf.set(name, str(limit))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns)


def byte_groups(batch, column: int = 1, limit: int = 4_000_000):
    """Slices of a record batch of about ``limit`` bytes of its string ``column``, so that the memory
    of a task follows this bound and not the Arrow batch.  One text is never cut."""
    import numpy as np

    array = batch.column(column)
    if not len(array):
        return
    ends = np.frombuffer(array.buffers()[1], dtype=np.int64 if "large" in str(array.type) else np.int32)[array.offset : array.offset + len(array) + 1]
    at = 0
    while at < len(array):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def local_path(uri: str) -> str:
    return uri[7:] if uri.startswith("file://") else uri


def ensure_dir(fs, path: str) -> None:
    fs.create_dir(path, recursive=True)


def filesystem(uri: str):
    """pyarrow file system and path of a URI (file, hdfs, s3, gs); used by Python tasks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + os.path.abspath(uri))


def resolved(column: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def columns_of(df: DataFrame) -> list[Column]:
    return [resolved(c) for c in df.columns]


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: What long-lived Python workers keep between tasks: name -> function that lets it go.
KEPT: dict = {}


def worker_for(name: str) -> None:
    """Called by a Python task of operator ``name``: what other operators keep in this worker goes,
    so that a worker's memory is that of one operator, however many it has served."""
    if others := [k for k in KEPT if k != name]:
        for other in others:
            KEPT.pop(other)()
        give_back()


def give_back() -> None:
    """Hand memory that this process has freed back to the system."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def lean(run):
    """A function of batches for ``mapInArrow`` that hands its memory back when its task ends: Spark
    keeps idle workers, and what they have freed would else stay theirs."""

    @functools.wraps(run)
    def tidy(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return tidy
