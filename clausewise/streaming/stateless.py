"""The stages on a stream: clauses, first occurrences, counts by window.

Splitting is stateless and the same expression as in a batch.  ``first_clauses`` keeps, for every text, the
first row by (seq, pos) that has arrived as the state of a streaming aggregate: an earlier occurrence
that arrives later takes its place, so when a stream has ended the rows are those of the batch.  Its state
holds one row a text; ``unique_clauses`` bounds it by a watermark instead and keeps the first to arrive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clausewise.operators.reviews import clause_reviews, first_occurrences, flatten


def clause_stream(reviews: DataFrame) -> DataFrame:
    """seq, review_id, place_name, content and any others (a stream or not) -> one row a clause."""
    return flatten(clause_reviews(reviews))


def first_clauses(clauses: DataFrame) -> DataFrame:
    """The first row by (seq, pos) of each stripped text, for the output modes complete and update."""
    return first_occurrences(clauses)


def unique_clauses(clauses: DataFrame, delay: str = "1 hour") -> DataFrame:
    return clauses.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["text"])


def sentiment_by_window(clauses: DataFrame, width: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    return clauses.withWatermark("ts", delay).groupBy(F.window("ts", width), "sentiment").agg(F.count("*").alias("n"))
