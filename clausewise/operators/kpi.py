"""KPI views over blocks, issues and sentiment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def volume(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.sum("size").cast("long").alias("clauses"), F.count("*").alias("blocks"))


def concentration(blocks: DataFrame) -> DataFrame:
    """Size extremes, mean, median, Gini, and the share of the largest tenth.

    Sizes are counted first, so the ordering runs over distinct sizes, not over blocks.
    """
    sizes = blocks.groupBy("size").agg(F.count("*").alias("n"))
    up = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    at = sizes.withColumns({
        "below": F.coalesce(F.sum("n").over(up), F.lit(0)), "above": F.coalesce(F.sum("n").over(down), F.lit(0)), "total": F.sum("n").over(everything)})
    top = F.ceil(F.col("total") * 0.1)
    ranked = at.select(
        "size", "n", "total",
        # ranks below+1 .. below+n of equal sizes, summed
        (F.col("size") * (F.col("n") * F.col("below") + F.col("n") * (F.col("n") + 1) / 2)).alias("weighted"),
        (F.col("size") * F.greatest(F.lit(0), F.least(F.col("n"), top - F.col("above")))).alias("top"))
    total, mass = F.max("total"), F.sum(F.col("size") * F.col("n"))
    return ranked.agg(
        F.min("size").cast("long").alias("min_size"), F.max("size").cast("long").alias("max_size"), (mass / total).alias("mean_size"),
        (2 * F.sum("weighted") / (total * mass) - (total + 1) / total).alias("gini"), (F.sum("top") / mass).alias("top_share")
    ).crossJoin(blocks.agg(F.percentile("size", 0.5).alias("median_size")))  # one row each


def per_place(blocks: DataFrame) -> DataFrame:
    return blocks.select(F.explode("place_names").alias("place"), "size").groupBy("place").agg(
        F.count("*").alias("blocks"), F.sum("size").cast("long").alias("clauses"))


def places_per_block(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.avg(F.size("place_names")).alias("avg_places"))


def severity(issues: DataFrame) -> DataFrame:
    """cluster_id, issue, importance, clause_count -> per block."""
    return issues.groupBy("cluster_id").agg(
        F.avg("importance").alias("mean_severity"), (F.avg("importance") * F.max("clause_count")).alias("weighted_volume"),
        F.countDistinct("issue").alias("diversity"))


def top_issues(issues: DataFrame, n: int = 10) -> DataFrame:
    """The most important issues; ties by issue, block, then the other columns."""
    first = ("importance", "issue", "cluster_id")
    return issues.orderBy(F.desc("importance"), "issue", "cluster_id", *[c for c in issues.columns if c not in first]).limit(n)


def severity_frequency(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue").agg((F.countDistinct("cluster_id") * F.avg("importance")).alias("priority"))


def mix(blocks: DataFrame, key: str) -> DataFrame:
    counts = blocks.groupBy(key).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def hhi(blocks: DataFrame, key: str) -> DataFrame:
    return mix(blocks, key).agg(F.sum(F.col("share") * F.col("share")).alias("hhi"))


def residual_rate(blocks: DataFrame, key: str, residual: str = "other") -> DataFrame:
    return blocks.agg(F.avg((F.col(key) == residual).cast("double")).alias("residual_rate"))


def sizes_in_group(blocks: DataFrame, group: str, sub: str) -> DataFrame:
    return blocks.groupBy(group, sub).agg(
        F.count("*").alias("n"), F.min("size").cast("long").alias("min_size"), F.max("size").cast("long").alias("max_size"), F.avg("size").alias("mean_size"))


def balance(negative: DataFrame, positive: DataFrame, by: str) -> DataFrame:
    """Counts, shares, ratio and net score by place (or time); a side without rows counts 0."""
    both = negative.groupBy(by).agg(F.count("*").alias("neg")).join(positive.groupBy(by).agg(F.count("*").alias("pos")), by, "full_outer").select(
        by, F.coalesce("neg", F.lit(0)).alias("neg"), F.coalesce("pos", F.lit(0)).alias("pos"))
    total = F.col("neg") + F.col("pos")
    return both.select(by, "neg", "pos", F.when(F.col("pos") > 0, F.col("neg") / F.col("pos")).alias("ratio"),
                       (F.col("neg") / total).alias("neg_share"), ((F.col("pos") - F.col("neg")) / total).alias("net"))


def issue_averages(issues: DataFrame) -> DataFrame:
    """Mean importance of each exact issue of a block, rounded half to even, in order of
    importance, then of first appearance."""
    means = issues.groupBy("cluster_id", "issue").agg(F.bround(F.avg("importance"), 0).cast("int").alias("importance"), F.min("pos").alias("pos"))
    item = F.struct((-F.col("importance")).alias("o"), "pos", "issue", "importance")
    return means.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["issue"], x["importance"])).alias("issues"))
