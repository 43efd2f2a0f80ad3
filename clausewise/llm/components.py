"""Connected components by alternating stars, entirely as DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b of one orderable type); a
    component is named by its smallest node.

    Each round hangs the larger neighbours of a node, then the smaller ones, on the smallest
    neighbour.  Rounds are written to the shared folder; neighbours of a node are only ever
    reduced to their minimum, so a hub of any degree costs one partial aggregate and one join
    that AQE can split.  Nulls and loops are ignored; no edges give no rows.
    """
    e = edges.where("a is not null and b is not null and a <> b").select(
        F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")
    )
    e = materialize(e.distinct(), "cc")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("least", "u").alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u <> v").distinct()
        )
        # large: each u now points only to smaller v
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
            .unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        )
        last, e = e, materialize(small, "cc")
        discard(last)
        # the rounds end when every node has exactly one pointer and no target points further
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        state = (now["n"], now["h"])
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not converge")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).groupBy("node").agg(
        F.min("component").alias("component")
    )
