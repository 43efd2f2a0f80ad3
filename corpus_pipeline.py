"""Corpus pipeline: toxicity, line dedup, near-dedup, secret scan, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last keep the columns
of documents.  ``run`` writes each stage's rows to the shared folder and hands them to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausewise.llm.common import columns_of, free_names, materialize, read_table, resolved, tokenizer_path
from clausewise.llm.line_dedup import dedup_lines
from clausewise.llm.near_copies import similar_components
from clausewise.llm.packing import pack
from clausewise.llm.secrets import redact
from clausewise.llm.toxicity import score, train


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below 0.3.  Null and empty texts have no evidence and stay; rows
    that repeat are treated alike; all columns stay, whatever their names; an empty table gives no
    rows."""
    model = train(docs, read_table(spark, sf_dir, "labels"))
    names = free_names(docs, "__score", "__toxic")
    return score(docs, model, threshold=0.3, names=names).where(F.col(names[1]) == 0).select(*columns_of(docs))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of 50 words go; n_chars follows; a document of which nothing is left
    repeats earlier ones whole and goes too.  Null texts stay null, and rows that repeat doc_id and
    text are one text and are treated alike; a null doc_id comes first; all columns stay, whatever
    their names; an empty table gives no rows."""
    names = free_names(docs, "__lines", "__runs", "__words")
    done = dedup_lines(docs, run=50, names=names).where((F.col(names[1]) == 0) | (F.col(names[2]) > 0))
    return done.withColumn("n_chars", F.length("text").cast("long")).select(*columns_of(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component stays: that of the smallest doc_id, by text hash among equal ids; a
    row without a doc_id stays only where no row of its component has one.  Rows are known by
    doc_id and text, so other texts under a repeated or missing doc_id are documents of their own;
    of rows that repeat both, the one of the least hash over all columns stays.  Texts are linked
    where their sets of five-word shingles have similarity 0.8 or more; null and empty texts are
    equal texts.  All columns stay, whatever their names; an empty table gives no rows."""
    text = F.coalesce(resolved("text"), F.lit(""))
    number, row = free_names(docs, "__id", "__row")
    keyed = docs.withColumns({number: F.coalesce(resolved("doc_id").cast("string"), F.lit("\0")), row: F.xxhash64(text)})
    rows = keyed.select(F.col(row).alias("row"), text.alias("text"))
    names = keyed.groupBy(F.col(row).alias("row")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").cast("long").alias("id"),
                       F.col(row).alias("row"), F.col(number).alias("key"))).alias("least"))
    kept = similar_components(rows, words=5, least=0.8).join(names, "row").groupBy("component").agg(F.min("least").alias("least")).select(
        F.col("least.key").alias(number), F.col("least.row").alias(row))
    whole = F.struct(*columns_of(docs))
    one = keyed.join(kept, [number, row], "left_semi").groupBy(number, row).agg(F.min_by(whole, F.xxhash64(F.to_json(whole))).alias("one"))
    return one.select(*[F.col("one").getField(c).alias(c) for c in docs.columns])


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every reported secret span is replaced by a mark; n_chars follows; all documents stay, null and
    empty texts and rows that repeat too; all columns stay, whatever their names; an empty table
    gives no rows."""
    return redact(docs).withColumn("n_chars", F.length("text").cast("long")).select(*columns_of(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens.  A null text is empty and holds the end id
    alone; rows that repeat a doc_id or have none are documents of their own; columns other than
    doc_id and text are not read; an empty table gives no rows."""
    return pack(docs, tokenizer_path("byte_bpe_50k.json"), length=2048, end_id=1).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash", drop_near_duplicates),
    ("secrets", mask_secrets),
    ("packing", pack_sequences),
]

#: The toxicity model and the packing plan are beyond SQL; tests hold line dedup, near copies, secret spans
#: and packing against brute force, and the toxicity model against held-out labels.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
