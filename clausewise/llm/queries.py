"""The contract queries: each applies its operator to the whole of its table and derives the
digest columns from the operator's real output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read_table, tokenizer_path

BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"


def op1_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sampling import sample_segmentations

    found = sample_segmentations(read_table(spark, sf_dir, "documents"), tokenizer_path(PIECES), k=2, seed=7)
    return found.select(
        "doc_id", "sample", "n_pieces", "log_prob", "perturbed", "inclusion", F.crc32("ids").alias("ids_crc32"),
        (F.col("decoded_crc32") == F.col("text_crc32")).alias("round_trip"),
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, write_token_files

    manifest = write_token_files(read_table(spark, sf_dir, "documents"), tokenizer_path(BPE), end_id=0)
    return read_token_files(manifest).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(read_table(spark, sf_dir, "documents"), tokenizer_path(BPE), length=2048, end_id=1).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import fold, score, train

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"))
    return score(docs, model, threshold=0.3).select(
        "doc_id", (fold(F.col("doc_id")) == 2).alias("held_out"), F.col("toxicity").alias("score"),
        F.col("toxic").alias("predicted"),
    )


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import main_text

    return main_text(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars")
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import hex16, near_duplicates

    return near_duplicates(read_table(spark, sf_dir, "documents"), words=4, radius=4).select(
        "doc_id", hex16("fp").alias("fingerprint"), "component_id"
    )


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .topk import quantized, top_k

    vectors = quantized(read_table(spark, sf_dir, "embeddings"), scale=256.0)
    return top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines

    return dedup_lines(read_table(spark, sf_dir, "documents"), run=50).select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"),
        "lines_deleted", "runs_deleted", "words_left",
    )


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import fingerprints

    return fingerprints(read_table(spark, sf_dir, "documents"), words=5, bits=2)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import report

    return report(read_table(spark, sf_dir, "documents"))


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical import build_index, search

    return search(build_index(read_table(spark, sf_dir, "documents")), read_table(spark, sf_dir, "benchmark"), k=20)


def op12_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .align import align

    return align(read_table(spark, sf_dir, "documents"), tokenizer_path(BPE), tokenizer_path(PIECES))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .best_fit import pack_best_fit

    return pack_best_fit(read_table(spark, sf_dir, "documents"), tokenizer_path(BPE), length=1024, end_id=2).drop("key")


QUERIES = {
    "op1_sampled_pieces": op1_sampled_pieces,
    "op7_top_k": op7_top_k,
    "op8_line_dedup": op8_line_dedup,
    "op9_fingerprints": op9_fingerprints,
    "op10_secrets": op10_secrets,
    "op2_toxicity": op2_toxicity,
    "op3_html_text": op3_html_text,
    "op4_simhash": op4_simhash,
    "op5_token_files": op5_token_files,
    "op6_packing": op6_packing,
    "op11_lexical": op11_lexical,
    "op12_align": op12_align,
    "op13_best_fit": op13_best_fit,
}

#: DuckDB counterparts; queries without one are held against brute force in tests/llm.
ORACLE_SQL: dict[str, str] = {
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.q) = len(b.q)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5
    """,
    "op11_lexical": r"""
        WITH t AS (
            SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents),
        q AS (
            SELECT item_id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        asked AS (SELECT item_id, term, count(*) AS times FROM q GROUP BY ALL),
        whole AS (SELECT CAST(count(*) AS BIGINT) AS nn, CAST(sum(len(terms)) AS BIGINT) AS ll FROM t WHERE len(terms) > 0),
        p AS (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM t),
        tf AS (SELECT row, doc_id, n, term, count(*) AS tf FROM p WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term, nn),
        s AS (
            SELECT item_id, row, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score
            FROM asked JOIN w USING (term) JOIN tf USING (term), whole GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM s WHERE score > 0)
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM r WHERE place <= 20
    """,
}
