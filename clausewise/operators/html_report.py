"""Static reports from bounded aggregates."""

from __future__ import annotations

import html
import json

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clausewise.functions.text import colour, html_escape
from clausewise.sources.shared import fresh

from .clusters import even_subsample, unit_vectors
from .metric import stored
from .vector_index import nearest_many, write_vector_balls


def drill_down_page(groups: DataFrame, title: str = "Taxonomy") -> str:
    """Groups, subcategories and blocks as nested details; the input is one row a group."""
    out = [f"<!doctype html><meta charset=utf-8><title>{html.escape(title)}</title>"]
    for g in groups.toLocalIterator():
        out.append(f"<details><summary>{html.escape(str(g['grp']))} ({g['block_count']}, {g['clause_total']})</summary>")
        for s in g["subcategories"]:
            rows = "".join(f"<li>{html.escape(str(b['block_name']))} ({b['size']})</li>" for b in s["blocks"])
            out.append(f"<details><summary>{s['label']} ({s['clause_total']})</summary><ul>{rows}</ul></details>")
        out.append("</details>")
    return "".join(out)


def scatter_page(points: DataFrame, width: int = 900, height: int = 600, each: int = 300, most: int = 50_000) -> str:
    """SVG of (seq, cluster, x, y, text), at most ``each`` points a cluster, evenly over it, and at most
    ``most`` of those, evenly over all.  Points are scaled in Spark; the page holds no more than these."""
    some = even_subsample(points, each)
    if some.count() > most:
        some = even_subsample(some.withColumns({"own": F.col("cluster"), "cluster": F.lit(0)}), most).withColumn("cluster", F.col("own")).drop("own")
    span = some.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))
    at = lambda v, low, high, size: F.when(F.col(high) > F.col(low), (F.col(v) - F.col(low)) / (F.col(high) - F.col(low)) * size).otherwise(0.0)
    placed = some.crossJoin(F.broadcast(span)).select(  # one row
        "seq", F.round(at("x", "x0", "x1", width), 1).alias("x"), F.round(at("y", "y0", "y1", height), 1).alias("y"),
        html_escape(F.substring("text", 1, 200)).alias("text"), colour(F.col("cluster")).alias("colour"))
    marks = [f'<circle cx="{r["x"]}" cy="{r["y"]}" r="3" fill="{r["colour"]}"><title>{r["text"] or ""}</title></circle>' for r in placed.orderBy("seq").collect()]
    return f'<!doctype html><meta charset=utf-8><svg width="{width}" height="{height}">{"".join(marks)}</svg><script>const n={json.dumps(len(marks))}</script>'


def project_2d(df: DataFrame) -> DataFrame:
    """Two principal components as x and y (a linear map)."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    rows = df.withColumn("v", array_to_vector(F.col("embedding").cast("array<double>")))
    out = PCA(k=2, inputCol="v", outputCol="p").fit(rows).transform(rows).withColumn("p", vector_to_array("p"))
    return out.withColumns({"x": F.col("p")[0], "y": F.col("p")[1]}).drop("v", "p")


def neighbour_layout(df: DataFrame, neighbours: int = 15, epochs: int = 30, seed: int = 7) -> DataFrame:
    """``df`` (seq, embedding and others) with x and y: a layout that keeps neighbours together.

    Every row is tied to its ``neighbours`` nearest ones with weights by local scale (the nearest counts 1, and
    the scale makes a row's weights add up to log2 of their number), symmetric.  From principal components
    on, every epoch moves a row towards its neighbours, by the weights, and away from as many rows drawn by a
    hash of the seed, the epoch and its seq; the step shrinks to nothing.  Positions are written between
    epochs, so the result follows from the seed alone, and no task holds more than its rows and edges.
    """
    base = stored(project_2d(unit_vectors(df.select("seq", "embedding"))).select("seq", "x", "y"), "layout")
    n = base.count()
    if n < 3:
        return df.join(base, "seq")
    near = nearest_rows(df.select("seq", "embedding"), min(neighbours, n - 1))
    edges = stored(fuzzy_edges(near), "layout-edges")
    span = base.agg(F.max(F.abs("x")).alias("x"), F.max(F.abs("y")).alias("y")).first()
    place = base.select("seq", (F.col("x") / (span["x"] or 1.0) * 10).alias("x"), (F.col("y") / (span["y"] or 1.0) * 10).alias("y"))
    order = stored(base.select("seq", (F.row_number().over(Window.partitionBy(F.pmod(F.xxhash64("seq"), F.lit(max(1, n // 5000)))).orderBy("seq")) - 1).alias("slot"),
                               F.pmod(F.xxhash64("seq"), F.lit(max(1, n // 5000))).alias("pool")), "layout-order")
    pools = order.groupBy("pool").agg(F.max("slot").alias("last"))
    a, b = 1.577, 0.895  # fixed values: the usual curve for points that may touch
    for epoch in range(epochs):
        step = 1.0 - epoch / epochs
        own, other = place.alias("o"), place.select(F.col("seq").alias("other"), F.col("x").alias("u"), F.col("y").alias("v"))
        pulled = edges.join(own, "seq").join(other, "other").withColumns({"dx": F.col("x") - F.col("u"), "dy": F.col("y") - F.col("v")}).withColumn(
            "d", F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
        pull = F.when(F.col("d") > 0, -2 * a * b * F.pow("d", b - 1) / (1 + a * F.pow("d", b))).otherwise(0.0) * F.col("weight")
        moves = pulled.select("seq", (pull * F.col("dx")).alias("mx"), (pull * F.col("dy")).alias("my"))
        # rows to move away from: drawn from the row's pool by hash
        draws = order.join(pools, "pool").withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(neighbours)))).select(
            "seq", "pool", F.pmod(F.xxhash64("seq", "k", F.lit(epoch), F.lit(seed)), F.col("last") + 1).cast("int").alias("slot"))
        drawn = draws.join(order.select("pool", "slot", F.col("seq").alias("other")), ["pool", "slot"]).where("seq <> other").join(own, "seq").join(other, "other").withColumns(
            {"dx": F.col("x") - F.col("u"), "dy": F.col("y") - F.col("v")}).withColumn("d", F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
        push = 2 * b / ((0.001 + F.col("d")) * (1 + a * F.pow("d", b)))
        hold = lambda c: F.greatest(F.lit(-4.0), F.least(F.lit(4.0), c))
        away = drawn.select("seq", hold(push * F.col("dx")).alias("mx"), hold(push * F.col("dy")).alias("my"))
        # sums in whole millionths: the same in any order
        whole = lambda c: F.round(hold(F.col(c)) * 1_000_000).cast("long")
        total = moves.unionByName(away).groupBy("seq").agg(F.sum(whole("mx")).alias("mx"), F.sum(whole("my")).alias("my"))
        place = stored(place.join(total, "seq", "left").select(
            "seq", (F.col("x") + F.coalesce(F.col("mx") / 1e6, F.lit(0.0)) * step * 0.2).alias("x"), (F.col("y") + F.coalesce(F.col("my") / 1e6, F.lit(0.0)) * step * 0.2).alias("y")), "layout")
    return df.join(place, "seq")


def nearest_rows(df: DataFrame, k: int) -> DataFrame:
    """(seq, rank, other, similarity): the ``k`` nearest other rows of every row, from a vector index in the
    shared folder."""
    spark = df.sparkSession
    path = fresh(spark, "layout-index")
    write_vector_balls(df, path, ball_bytes=1 << 20)
    found = nearest_many(spark, path, df.withColumnRenamed("seq", "question"), k + 1).where("question <> seq")
    by = Window.partitionBy("question").orderBy("rank")
    return stored(found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        F.col("question").alias("seq"), "rank", F.col("seq").alias("other"), "similarity"), "nearest-rows")


def fuzzy_edges(near: DataFrame) -> DataFrame:
    """(seq, other, weight), both ways: exp(-(distance - least) / scale) for the scale at which a row's weights add
    up to log2 of their number, and a + b - ab for the two directions."""
    @F.pandas_udf("double")
    def scale(distances: pd.Series) -> pd.Series:
        out = []
        for d in distances:
            d = np.sort(np.asarray(d, dtype=np.float64))
            gap, want, low, high, s = d - d[0], np.log2(max(2, len(d))), 0.0, np.inf, 1.0
            for _ in range(64):
                got = np.exp(-gap / s).sum()
                if abs(got - want) < 1e-5:
                    break
                low, high = (low, s) if got > want else (s, high)
                s = (low + high) / 2 if np.isfinite(high) else s * 2
            out.append(max(s, 1e-3 * max(d.mean(), 1e-12)))
        return pd.Series(out)

    rows = near.select("seq", "other", F.greatest(F.lit(0.0), 1 - F.col("similarity")).alias("d"))
    local = rows.groupBy("seq").agg(F.array_sort(F.collect_list("d")).alias("ds")).select("seq", F.col("ds")[0].alias("least"), scale("ds").alias("scale"))  # k numbers a row
    one = rows.join(local, "seq").select("seq", "other", F.exp(-(F.col("d") - F.col("least")) / F.col("scale")).alias("w"))
    both = one.unionByName(one.select(F.col("other").alias("seq"), F.col("seq").alias("other"), "w"))
    return both.groupBy("seq", "other").agg((F.sum("w") - F.when(F.count("*") > 1, F.min("w") * F.max("w")).otherwise(0.0)).alias("weight"))
