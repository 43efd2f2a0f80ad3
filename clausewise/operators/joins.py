"""Joining reviews with places, translation swap, keyword and token joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise.functions.text import not_blank, place_tokens, strip


def join_reviews(left: DataFrame, right: DataFrame, key: str, left_columns=None, right_columns=None, null_keys_match: bool = True) -> DataFrame:
    """Inner join on ``key``, which leaves the output; missing keys match missing ones by default.

    No broadcast is forced: Catalyst and AQE choose by the sides' sizes.
    """
    rights = [c for c in right.columns if c != key] if right_columns is None else [c for c in right_columns if c != key]
    lefts = [] if left_columns is None else [c for c in left_columns if c != key]
    a = left.select(*lefts, F.col(key).alias("__l"))
    b = right.select(*rights, F.col(key).alias("__r"))
    on = F.col("__l").eqNullSafe(F.col("__r")) if null_keys_match else F.col("__l") == F.col("__r")
    return a.join(b, on, "inner").drop("__l", "__r")


def swap_translation(df: DataFrame, content: str = "content", translated: str = "translated_content") -> DataFrame:
    """A translation that is not blank takes the place of the content; its column goes."""
    return df.withColumn(content, F.when(not_blank(F.col(translated)), strip(F.col(translated))).otherwise(F.col(content))).drop(translated)


def swap_counts(df: DataFrame, translated: str = "translated_content") -> DataFrame:
    """One row: rows, and how many of them have a translation that takes the content's place."""
    return df.agg(F.count("*").alias("rows"), F.count_if(not_blank(F.col(translated))).alias("swapped"))


def first_keyword(text: Column, keywords: list[str]) -> Column:
    """The first keyword, in list order, that the text contains in any case; else null."""
    return F.get(F.filter(F.array(*map(F.lit, keywords)), lambda k: F.contains(F.lower(text), F.lower(k))), 0)


def place_overlap(reviews: DataFrame, places: DataFrame) -> DataFrame:
    """(review_id, place) with a token in common; an equi-join on tokens, never all pairs."""
    r = reviews.select("review_id", F.explode(place_tokens(F.col("text"))).alias("token"))
    p = places.select("place", F.explode(place_tokens(F.col("place"))).alias("token"))
    return r.join(p, "token").select("review_id", "place").distinct()


def distinct_places(places: DataFrame) -> DataFrame:
    """First place, by seq, of each set of tokens; places without tokens go."""
    keyed = places.withColumn("__k", F.array_sort(place_tokens(F.col("place")))).where(F.size("__k") > 0)
    first = Window.partitionBy("__k").orderBy("seq")
    return keyed.withColumn("__n", F.row_number().over(first)).where("__n = 1").drop("__n", "__k")


def route_query(query: str, places: DataFrame, coverage: float = 0.25) -> DataFrame:
    """The place (at most one row) that a query names best: overlap, then specificity, then
    coverage, then the earlier place."""
    q = place_tokens(F.lit(query))
    # the query is tokenised in full; places drop words that are too common to tell them apart
    scored = places.select("place", "seq", place_tokens(F.col("place"), generic=False).alias("t")).where(F.size("t") > 0).select(
        "place", "seq", F.size(F.array_intersect(q, F.col("t"))).alias("overlap"), F.size("t").alias("n"), F.size(q).alias("m"))
    good = scored.where((F.col("overlap") > 0) & (F.col("overlap") / F.col("m") >= coverage))
    best = F.struct("overlap", (F.col("overlap") / F.col("n")).alias("specificity"), (F.col("overlap") / F.col("m")).alias("coverage"), (-F.col("seq")).alias("s"))
    return good.agg(F.max_by("place", best).alias("place"), F.max("overlap").alias("n")).where("place is not null").select("place")


def global_search(query: str, reviews: DataFrame, k: int = 15, has_tokens: bool | None = None) -> DataFrame:
    """Reviews by shared tokens, then the worse rating (NaN counts 3), then seq; a query without
    tokens gives the newest."""
    q = place_tokens(F.lit(query))
    if has_tokens is None:
        has_tokens = bool(reviews.sparkSession.range(1).select(F.size(q).alias("n")).first()["n"])
    if not has_tokens:
        return reviews.withColumn("overlap", F.lit(0)).orderBy(F.desc("date"), "seq").limit(k)
    overlap = F.size(F.array_intersect(q, place_tokens(F.col("text"))))
    return reviews.withColumn("overlap", overlap).where("overlap > 0").orderBy(
        F.desc("overlap"), F.coalesce(F.nanvl("rating", F.lit(3.0)), F.lit(3.0)), "seq").limit(k)


def worst_of_place(reviews: DataFrame, k: int = 15, newest_first: bool = False) -> DataFrame:
    date = F.desc("date") if newest_first else F.asc("date")
    return reviews.orderBy(F.coalesce(F.nanvl("rating", F.lit(3.0)), F.lit(3.0)), date, "seq").limit(k)


def search_reviews(query: str, reviews: DataFrame, places: DataFrame, k: int = 15) -> tuple[DataFrame, str | None]:
    """The routed place's worst reviews and its name, or a search over all and no name."""
    routed = route_query(query, places).first()
    if routed:
        mine = reviews.join(place_overlap(reviews, places.where(F.col("place") == routed["place"])).select("review_id"), "review_id", "left_semi")
        if not mine.isEmpty():
            return worst_of_place(mine, k), routed["place"]
    return global_search(query, reviews, k), None


def by_position(vectors: DataFrame, metadata: DataFrame) -> DataFrame:
    """Row i of one with row i of the other, by their ``position``; rows without a partner go."""
    return vectors.join(metadata, "position")


def locations(df: DataFrame, column: str = "location_name") -> DataFrame:
    """(location): the distinct ones that are not blank, in order."""
    return df.where(not_blank(F.col(column))).select(F.col(column).alias("location")).distinct().orderBy("location")


def at_location(df: DataFrame, location: str | None = None, column: str = "location_name") -> DataFrame:
    """Rows of exactly that location; all rows without one."""
    return df.where(F.col(column) == location) if location else df
