"""The batch pipeline as one lazy chain, with optional Parquet stops to start again from."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clausewise.functions.text import not_blank
from clausewise.operators import reviews as R
from clausewise.operators.joins import join_reviews, swap_translation
from clausewise.operators.providers import with_embedding, with_sentiment

STAGES = ("join", "swap", "split", "classify", "flatten", "embed")


def run(spark: SparkSession, reviews: DataFrame, places: DataFrame, sentiment, embedding, sentiment_wanted: str = "negative",
        skip_swap: bool = False, start: int = 1, folder: str | None = None, times: dict | None = None,
        counts: dict | None = None) -> DataFrame:
    """Embedded clauses of one sentiment from raw reviews and places.

    With ``folder`` each stage is written there and read back, and ``start`` (from 1) begins after
    stages that are there already; a failing stage ends the run.  ``counts`` gets, by stage, an
    ``Observation`` of its rows (joined; swapped; split: read, written and clauses; classified; flattened),
    filled by the action that runs over them, without a pass of its own.
    """
    def seen(name: str, df: DataFrame, **what) -> DataFrame:
        if counts is None:
            return df
        counts[name] = Observation(name)
        return df.observe(counts[name], *[c.alias(k) for k, c in what.items()])

    rows = F.count("*")
    df: DataFrame | None = None

    def stage(n: int, make) -> None:
        nonlocal df
        if folder and n < start:
            df = spark.read.parquet(f"{folder}/{STAGES[n - 1]}")
            return
        began = time.time()
        df = make(df)
        if folder:
            df.write.mode("overwrite").parquet(f"{folder}/{STAGES[n - 1]}")
            df = spark.read.parquet(f"{folder}/{STAGES[n - 1]}")
        if times is not None:
            times[STAGES[n - 1]] = time.time() - began

    stage(1, lambda _: seen("join", join_reviews(
        reviews, places.drop("seq"), "google_place_id", ["seq", "review_id", "content", "translated_content"], ["place_name"]), rows=rows))
    stage(2, lambda d: d.drop("translated_content") if skip_swap else swap_translation(
        seen("swap", d, rows=rows, swapped=F.count_if(not_blank(F.col("translated_content"))))))
    stage(3, lambda d: seen("split", R.clause_reviews(seen("read", d, rows=rows)), written=rows, clauses=F.sum(F.size("clauses"))))

    def classify(d: DataFrame) -> DataFrame:
        flat = R.flatten(d.select("seq", "review_id", "place_name", "clauses"))
        scored = seen("classify", with_sentiment(R.first_occurrences(flat), sentiment), rows=rows)
        return R.nest_by_review(scored.withColumn("sentiment", R.sentiment_of(F.col("label"))))

    stage(4, classify)
    stage(5, lambda d: seen("flatten", d.where(F.col("sentiment") == sentiment_wanted).select(
        "seq", "place_name", F.nullif("review_key", F.lit("")).alias("review_id"), F.posexplode("clauses").alias("pos", "c")).select(
        "seq", "pos", "c.clause_id", "c.clause_text", "place_name", "review_id", "c.sentence_no", "c.score"), rows=rows))
    stage(6, lambda d: with_embedding(d, embedding, "clause_text"))
    return df
