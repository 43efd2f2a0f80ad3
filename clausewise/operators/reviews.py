"""Stages on reviews: clauses, unique clauses, sentiment, nesting, flattening, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clausewise.functions.text import clean_text, detect_lang, not_blank, split_clauses, strip


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores, before a step that costs far more than a shuffle: a table that is estimated to be
    smaller than a split for each core may lie in one file of one split, and is dealt anew.  Others,
    and streams, stay as they are; no job runs to decide."""
    if df.isStreaming:
        return df
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if size < cores * split else df


def clause_reviews(df: DataFrame, min_words: int = 3, semicolons: bool = False) -> DataFrame:
    """seq, review_id, place_name, content -> cleaned rows with nested clauses; blank rows go."""
    lang = F.coalesce(F.col("lang"), detect_lang(F.col("content"))) if "lang" in df.columns else detect_lang(F.col("content"))
    rows = spread(df).withColumn("content", clean_text(F.col("content"))).where(not_blank(F.col("content"))).withColumn("__lang", lang)
    found = rows.withColumn("__c", split_clauses(F.col("content"), F.col("__lang"), min_words, semicolons))
    clauses = F.transform("__c", lambda x, i: F.struct(
        F.concat(F.coalesce("review_id", F.lit("")), F.lit("_c"), (i + 1).cast("string")).alias("clause_id"),
        x["sentence_no"].alias("sentence_no"), x["text"].alias("text")))
    return found.withColumns({"clauses": clauses, "review_id": F.nullif("review_id", F.lit("")), "place_name": F.nullif("place_name", F.lit(""))}).drop("__c", "__lang")


def row_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: rows read by a stage, rows it wrote and rows it left out."""
    return before.agg(F.count("*").alias("read")).crossJoin(after.agg(F.count("*").alias("written"))).withColumn("skipped", F.col("read") - F.col("written"))


def clause_stats(df: DataFrame) -> DataFrame:
    sentences = F.transform("clauses", lambda c: c["sentence_no"])
    return df.agg(
        F.count("*").alias("reviews"), F.sum(F.size("clauses")).cast("long").alias("clauses"),
        F.sum(F.coalesce(F.array_max(sentences), F.lit(0))).cast("long").alias("sentences"),
        F.sum((F.size("clauses") > F.size(F.array_distinct(sentences))).cast("int")).cast("long").alias("reviews_split"))


def flatten(df: DataFrame) -> DataFrame:
    """One row a clause; reviews without clauses give none.

    Outer, then filtered: for a plain explode Catalyst adds a filter on the size of the array below
    the projection that makes it, so clauses would be split twice.
    """
    return df.select("*", F.posexplode_outer("clauses").alias("pos", "c")).where("pos is not null").select(
        *[c for c in df.columns if c != "clauses"], "pos", "c.*")


def first_occurrences(df: DataFrame, text: str = "text", order: tuple[str, ...] = ("seq", "pos"), scope: str = "global") -> DataFrame:
    """The first row, by ``order``, of each stripped text; ``scope='none'`` keeps all.

    Reduced by hash aggregation (partial before the shuffle), so a very common text costs no more.
    """
    rows = df.withColumn(text, strip(F.col(text))).where(F.col(text) != "")
    if scope == "none":
        return rows
    packed = rows.groupBy(text).agg(F.min_by(F.struct(*[c for c in rows.columns if c != text]), F.struct(*order)).alias("__r"))
    return packed.select(*[F.col(c) if c == text else F.col(f"__r.{c}").alias(c) for c in rows.columns])


def sentiment_of(label: Column) -> Column:
    """1-2 stars negative, 4-5 positive, all else neutral."""
    stars = F.regexp_extract(label.cast("string"), "^([1-5])", 1)
    return F.when(stars.isin("1", "2"), "negative").when(stars.isin("4", "5"), "positive").otherwise("neutral")


def nest_by_review(df: DataFrame) -> DataFrame:
    """Scored clauses back to reviews, one row a (sentiment, review); missing ids are one review."""
    key = F.coalesce("review_id", F.lit(""))
    clause = F.struct("seq", "pos", F.struct("clause_id", F.col("text").alias("clause_text"), "sentence_no", F.bround("score", 4).alias("score")).alias("c"))
    return df.groupBy("sentiment", key.alias("review_key")).agg(
        F.min("seq").alias("seq"), F.min_by("place_name", F.struct("seq", "pos")).alias("place_name"),
        F.transform(F.array_sort(F.collect_list(clause)), lambda x: x["c"]).alias("clauses"))


def sentiment_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("sentiment").agg(F.count("*").alias("n"))


def sections(text: DataFrame, prefix: str = "## ") -> DataFrame:
    """(doc, header, body) of Markdown sections; lines of a single # are left out, empty bodies go."""
    lines = text.select("doc", F.posexplode(F.split("text", "\r?\n")).alias("n", "line"))
    running = Window.partitionBy("doc").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = F.col("line").startswith(prefix)
    marked = lines.withColumn("s", F.sum(head.cast("int")).over(running)).where("s > 0")
    body = F.when(~head & ~F.col("line").startswith("# "), F.struct("n", "line"))
    out = marked.groupBy("doc", "s").agg(
        F.max(F.when(head, strip(F.col("line").substr(F.lit(len(prefix) + 1), F.length("line"))))).alias("header"),
        strip(F.array_join(F.transform(F.array_sort(F.collect_list(body)), lambda x: x["line"]), "\n")).alias("body"))
    return out.where("body <> ''").select("doc", F.col("s").alias("section"), "header", "body")
