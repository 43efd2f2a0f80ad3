"""A vector index whose search skips files.

The index is the chunk table of ``metric``, one ball (a chunk of neighbouring unit vectors with centre and
radius) a folder.  Questions are packed the same way.  Every chunk of questions first searches the ball with
the highest bound; the worst k-th similarity found there is a floor for the chunk, and only balls whose
bound reaches it are opened after that.  Results are exact.
"""

from __future__ import annotations

import logging

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusters import unit_vectors
from .metric import MOST_CELLS, Chunks, candidates, multiply, pack, stored

log = logging.getLogger(__name__)


def write_vector_balls(df: DataFrame, path: str, ball_bytes: int = 8 << 20, cells: int | None = None) -> None:
    """``df``: seq (unique long), embedding; vectors of length zero are left out."""
    chunks = pack(unit_vectors(df).select("seq", "embedding"), cells, ball_bytes)
    chunks.table.write.mode("overwrite").partitionBy("chunk").parquet(f"{path}/balls")
    spark = df.sparkSession
    rows = [(i, p.tolist(), float(r), float(n)) for i, (p, r, n) in enumerate(zip(chunks.pivots, chunks.reach, chunks.norm, strict=True))]
    spark.createDataFrame(rows, "cell int, pivot array<double>, reach double, norm double").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


def open_vector_balls(spark: SparkSession, path: str) -> Chunks:
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()  # 1,024 at most
    schema = "cell int, n int, ids array<long>, vectors binary, centre array<double>, radius double, norm double, reach double, chunk long"
    table = spark.read.schema(schema).parquet(f"{path}/balls") if cells else spark.createDataFrame([], schema)
    return Chunks(table, np.array([r["pivot"] for r in cells]), np.array([r["reach"] for r in cells]), np.array([r["norm"] for r in cells]), table.select("chunk").count() if cells else 0, f"{path}/balls", True)


def nearest_many(spark: SparkSession, path: str, questions: DataFrame, k: int = 15) -> DataFrame:
    """question, rank, seq, similarity: for every row of ``questions`` (question: unique long, embedding) the ``k`` vectors
    of the largest cosine similarity, then by seq; fewer vectors give fewer rows.  How many balls were
    opened is logged."""
    import pyarrow as pa

    index = open_vector_balls(spark, path)
    # a cell a question while they are few: what a chunk opens follows its worst question
    asked = pack(unit_vectors(questions.withColumnRenamed("question", "seq")).select("seq", "embedding"), min(MOST_CELLS, max(1, questions.count())))
    if not index.count or not asked.count:
        return spark.createDataFrame([], "question long, rank int, seq long, similarity double")

    def top(x, y, s, same):
        order = np.lexsort((np.broadcast_to(y, s.shape), -s), axis=1)[:, :k]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(x, order.shape[1])), pa.array(y[order].ravel()), pa.array(np.take_along_axis(s, order, axis=1).ravel())], names=["question", "seq", "similarity"])

    def search(pairs):
        balls = [r["b"] for r in pairs.select("b").distinct().collect()]  # a number a file
        return multiply(pairs, asked, index, top, "question long, seq long, similarity double"), set(balls)

    def best(found):
        by = Window.partitionBy("question").orderBy(F.desc("similarity"), "seq")
        return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)

    every = candidates(asked, index, float("-inf"))
    first = stored(every.groupBy("a").agg(F.max_by("b", F.struct("most", "b")).alias("b")), "first-balls")
    found, opened = search(first)
    found = stored(best(found), "found-first")
    kth = found.where(F.col("rank") == k).select(F.col("question").alias("seq"), F.col("similarity").alias("kth"))
    floor = asked.table.select("chunk", F.explode("ids").alias("seq")).join(kth, "seq", "left").groupBy("chunk").agg(
        F.min(F.coalesce("kth", F.lit(float("-inf")))).alias("least"))
    rest = stored(candidates(asked, index, stored(floor, "floors")).select("a", "b").join(first, ["a", "b"], "left_anti"), "other-balls")
    more, others = search(rest)
    log.info("vector index: %d of %d balls opened", len(opened | others), index.count)
    out = best(found.drop("rank").unionByName(more))
    return out.select("question", F.col("rank").cast("int").alias("rank"), "seq", "similarity")
