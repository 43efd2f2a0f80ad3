"""An inverted index over reviews and places, and many questions in one plan.

Reviews are tokenised once, when the index is written: a posting is (token, review) with what ranks a
review, sorted by token so that a scan for some tokens skips the rest.  Places keep their postings for
both uses: all tokens attach reviews to a place, the distinguishing ones route questions to it.
Questions are joined to postings on their tokens; a question's best reviews are cut by a window that
Spark applies before the shuffle as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.functions.text import place_tokens

from .joins import distinct_places

REVIEW = "review_id, seq, rating, date".split(", ")


def write_review_index(reviews: DataFrame, places: DataFrame, path: str) -> None:
    """``reviews``: review_id, seq, text, rating, date; ``places``: seq, place (of places with equal tokens the
    first counts).  A rating that is null or NaN counts as 3."""
    rating = F.coalesce(F.nanvl(F.col("rating").cast("double"), F.lit(3.0)), F.lit(3.0)).alias("rating")
    rows = reviews.select("review_id", "seq", rating, "date", place_tokens(F.col("text")).alias("tokens"))
    rows.select(F.explode("tokens").alias("token"), *REVIEW).repartitionByRange("token", "seq").sortWithinPartitions("token", "seq").write.mode("overwrite").parquet(f"{path}/postings")
    reviews.select("review_id", "seq", rating, "date").repartitionByRange("date", "seq").sortWithinPartitions(F.desc("date"), "seq").write.mode("overwrite").parquet(f"{path}/reviews")
    known = distinct_places(places)
    for name, generic in (("attach", True), ("route", False)):
        tokens = known.select("place", "seq", place_tokens(F.col("place"), generic=generic).alias("tokens"))
        tokens.select(F.explode("tokens").alias("token"), "place", "seq", F.size("tokens").alias("n")).repartitionByRange("token").sortWithinPartitions(
            "token").write.mode("overwrite").parquet(f"{path}/{name}")


def best(rows: DataFrame, order: list, k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy("question").orderBy(*order))).where(F.col("rank") <= k)


def search_many(spark: SparkSession, path: str, questions: DataFrame, k: int = 15, coverage: float = 0.25) -> DataFrame:
    """question, rank, review_id, place for every row of ``questions`` (question: unique, text).

    The place that a question names best (overlap, then specificity, then coverage, then the earlier place)
    gives its worst reviews, by rating, date and seq; a question that names none, or one without reviews,
    gets the reviews with the most tokens of its own, then by rating and seq, and ``place`` is null; a
    question without tokens gets the newest.  Fewer reviews give fewer rows.
    """
    postings, reviews = spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/reviews")
    asked = questions.select("question", place_tokens(F.coalesce("text", F.lit(""))).alias("tokens"))
    tokens = asked.select("question", F.explode("tokens").alias("token"), F.size("tokens").alias("m"))
    shared = tokens.join(spark.read.parquet(f"{path}/route"), "token").groupBy("question", "place").agg(
        F.count("*").alias("overlap"), F.first("n").alias("n"), F.first("m").alias("m"), F.first("seq").alias("seq"))
    order = F.struct("overlap", (F.col("overlap") / F.col("n")).alias("specificity"), (F.col("overlap") / F.col("m")).alias("coverage"), (-F.col("seq")).alias("s"))
    routed = shared.where(F.col("overlap") / F.col("m") >= coverage).groupBy("question").agg(F.max_by("place", order).alias("place"))
    # reviews of each place that is asked for, once, however many questions name it
    named = routed.select("place").distinct()
    attached = spark.read.parquet(f"{path}/attach").join(named, "place", "left_semi").select("token", "place").join(postings, "token").select("place", *REVIEW).distinct()
    by_place = Window.partitionBy("place").orderBy("rating", F.asc("date"), "seq")
    worst = attached.withColumn("rank", F.row_number().over(by_place)).where(F.col("rank") <= k).select("place", "rank", "review_id")
    local = routed.join(worst, "place").select("question", "rank", "review_id", "place")
    open_ = asked.join(local.select("question").distinct(), "question", "left_anti")
    found = tokens.join(open_.select("question"), "question", "left_semi").join(postings, "token").groupBy("question", *REVIEW).agg(F.count("*").alias("overlap"))
    everywhere = best(found, [F.desc("overlap"), "rating", "seq"], k).select("question", "rank", "review_id", F.lit(None).cast("string").alias("place"))
    newest = reviews.orderBy(F.desc("date"), "seq").limit(k)  # k rows
    newest = newest.select(F.row_number().over(Window.orderBy(F.desc("date"), "seq")).alias("rank"), "review_id")
    bare = open_.where(F.size("tokens") == 0).select("question").crossJoin(F.broadcast(newest)).select("question", "rank", "review_id", F.lit(None).cast("string").alias("place"))
    return local.unionByName(everywhere).unionByName(bare)
