"""Work in steps of bounded size: what a run that breaks off loses is one step."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import fresh


def in_steps(df: DataFrame, every: int, label: str = "steps") -> Iterator[DataFrame]:
    """The rows of ``df`` in tables of about ``every`` rows.  ``df`` is computed once, into files of at
    most ``every`` rows in the shared folder; a step reads whole files, so no row is read twice."""
    spark = df.sparkSession
    path = fresh(spark, label)
    df.write.option("maxRecordsPerFile", every).parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    files = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n")).orderBy("file").collect()  # a row a file
    step, size = [], 0
    for r in files:
        if step and size + r["n"] > every:
            yield spark.read.schema(df.schema).parquet(*step)
            step, size = [], 0
        step.append(r["file"])
        size += r["n"]
    if step:
        yield spark.read.schema(df.schema).parquet(*step)
