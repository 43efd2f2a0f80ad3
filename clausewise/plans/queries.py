"""Registered queries of the review engine on the driver's tables, each with DuckDB SQL."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clausewise.functions import arrays as A
from clausewise.functions import replies as J
from clausewise.functions import text as X
from clausewise.operators import clusters as C
from clausewise.operators import joins as JN
from clausewise.operators import kpi as K
from clausewise.operators import knowledge as KB
from clausewise.operators import reviews as R
from clausewise.operators import taxonomy as T
from clausewise.operators.keywords import first_of_keywords
from clausewise.operators.ledger import Ledger
from clausewise.operators.ordered_merge import merge_ordered
from clausewise.operators.review_index import search_many, write_review_index
from clausewise.operators.vector_index import nearest_many, write_vector_balls
from clausewise.sources import readers, writers
from clausewise.sources.shared import fresh
from clausewise.streaming.stateless import first_clauses

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def quoted(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STRIP = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"

# ---- joins and projections -------------------------------------------------


@query("""
    WITH l AS (SELECT CAST(doc_id AS VARCHAR) AS k, lang FROM documents UNION ALL VALUES (NULL, 'none'), ('', 'blank')),
    r AS (SELECT CAST(doc_id AS VARCHAR) AS k, quality FROM labels UNION ALL VALUES (NULL, 7), ('', 8), ('', 9))
    SELECT lang, quality FROM l JOIN r ON l.k IS NOT DISTINCT FROM r.k""")
def join_inner_nullsafe(spark, d):
    left = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("k"), "lang").unionByName(
        spark.createDataFrame([(None, "none"), ("", "blank")], "k string, lang string"))
    right = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("k"), "quality").unionByName(
        spark.createDataFrame([(None, 7), ("", 8), ("", 9)], "k string, quality int"))
    return JN.join_reviews(left, right, "k", ["lang"], ["quality"])


@query(f"""
    SELECT conv_id, turn, CASE WHEN turn % 3 = 0 AND {STRIP.format('text')} <> '' THEN {STRIP.format('text')} ELSE text END AS content
    FROM conversations""")
def swap_conditional(spark, d):
    rows = table(spark, d, "conversations").select(
        "conv_id", "turn", F.col("text").alias("content"),
        F.when(F.col("turn") % 3 == 0, F.concat(F.lit("  "), "text", F.lit(" \n"))).otherwise(F.lit(" ")).alias("translated_content"))
    return JN.swap_translation(rows)


@query("""
    SELECT lang, n, CAST(row_number() OVER (ORDER BY n DESC, o) AS INTEGER) AS rank FROM (SELECT lang, count(*) AS n, min(doc_id) AS o FROM documents GROUP BY lang)""")
def per_language_count(spark, d):
    return T.category_summary(table(spark, d, "documents"), "lang", "doc_id")


# ---- text ------------------------------------------------------------------

JUNK = "o''f,,,, ,  x\r\n \n y"


@query(r"""
    WITH t AS (SELECT doc_id, replace(text, ' of ', 'o''''f,,,, ,' || chr(160) || ' x' || chr(13) || chr(10) || ' ' || chr(10) || ' y') AS x FROM documents)
    SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(replace(replace(regexp_replace(replace(x, '''''', ''''),
        '(?:[ \t]*,){3,}[ \t]*', '', 'g'), chr(13) || chr(10), chr(10)), chr(13), chr(10)), '[ \t' || chr(160) || ']+', ' ', 'g'),
        '\n\s*\n+', chr(10), 'g'), '^\s+|\s+$', '', 'g') AS content FROM t""")
def clean_text(spark, d):
    dirty = F.replace(F.col("text"), F.lit(" of "), F.lit(JUNK))
    return table(spark, d, "documents").select("doc_id", X.clean_text(dirty).alias("content"))


@query("WITH w AS (SELECT doc_id, list_slice(regexp_extract_all(lower(text), '[A-Za-zÀ-ÿ]+'), 1, 30) AS w FROM documents) SELECT doc_id, CASE " + " ".join(
    f"WHEN list_has_any(w, {quoted(m)}) THEN '{k}'" for k, m in X.MARKERS.items()) + " ELSE 'en' END AS detected FROM w")
def detect_lang(spark, d):
    return table(spark, d, "documents").select("doc_id", X.detect_lang(F.col("text")).alias("detected"))


_SENTENCES = r"""
    WITH a AS (SELECT doc_id, regexp_replace(translate({text}, '()', '  '), '(?i)(^|[^\pL\pN_])(mr|mrs|ms|dr|st|mt|jr|sr|vs|approx|e\.g|i\.e|a\.m|p\.m)\.', '\1\2' || chr(8228), 'g') AS t FROM documents),
    b AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(t, '([.!?…]["''”’)\]]?)\s+', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'),
        '([a-zà-ÿ][a-zà-ÿ][.!?])([A-ZÀ-Ý])', '\1' || chr(1) || '\2', 'g') AS t FROM a),
    s AS (SELECT doc_id, list_filter(string_split(t, chr(1)), lambda x: regexp_matches(x, '\S')) AS sentences FROM b)"""


@query(_SENTENCES.replace("{text}", "text") + """
    SELECT doc_id, CAST(len(sentences) AS INTEGER) AS n, replace(array_to_string(sentences, '|'), chr(8228), '.') AS sentences FROM s""")
def sentence_split(spark, d):
    plain = F.translate("text", "()", "  ")
    return table(spark, d, "documents").withColumn("s", X.sentences(plain)).select(
        "doc_id", F.size("s").alias("n"), X.unmark(F.array_join("s", "|")).alias("sentences"))


_OPENERS_EN = X.OPENERS["en"].replace(r"(?!\s+also)", "")
_AFTER_EN = X.AFTER_MARK["en"]
_CLAUSES = _SENTENCES.replace("{text}", "replace(replace(text, ' of ', ' but '), ' and ', ', however ')") + rf""",
    p AS (SELECT doc_id, list_transform(sentences, lambda x: string_split(regexp_replace(regexp_replace(x,
        '(?:\s*[,;:]\s*|\s+)((?i:{_OPENERS_EN})(?:[^\pL\pN_]|$))', chr(1) || '\1', 'g'),
        '\s*[,;]\s*((?i:{_AFTER_EN})(?:[^\pL\pN_]|$))', chr(1) || '\1', 'g'), chr(1))) AS p FROM s),
    k AS (SELECT doc_id, list_filter(list_transform(p, lambda x: list_filter(list_transform(list_filter(x, lambda y: regexp_matches(y, '\S')),
        lambda y: replace(regexp_replace(y, '^[ ,;:–—\-\n]+|[ ,;:–—\-\n]+$', '', 'g'), chr(8228), '.')), lambda y: regexp_matches(y, '[\pL\pN_]'))), lambda x: len(x) > 0) AS k FROM p)"""


def _with_clauses(spark, d):
    text = F.translate(F.replace(F.replace(F.col("text"), F.lit(" of "), F.lit(" but ")), F.lit(" and "), F.lit(", however ")), "()", "  ")
    return table(spark, d, "documents").select("doc_id", X.split_clauses(text, F.lit("en"), 1).alias("clauses"))


@query(_CLAUSES + "SELECT doc_id, CAST(len(flatten(k)) AS INTEGER) AS n, array_to_string(flatten(k), '|') AS clauses FROM k")
def clause_split(spark, d):
    return _with_clauses(spark, d).select(
        "doc_id", F.size("clauses").alias("n"), F.array_join(F.transform("clauses", lambda c: c["text"]), "|").alias("clauses"))


@query(_CLAUSES + """SELECT count(*) AS reviews, CAST(sum(len(flatten(k))) AS BIGINT) AS clauses, CAST(sum(len(k)) AS BIGINT) AS sentences,
    count(*) FILTER (len(list_filter(k, lambda x: len(x) > 1)) > 0) AS reviews_split FROM k""")
def clause_stats(spark, d):
    return R.clause_stats(_with_clauses(spark, d))


@query()
def clause_reviews(spark, d):
    rows = table(spark, d, "documents").select(
        F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("review_id"), F.col("source").alias("place_name"), F.col("text").alias("content"))
    return R.flatten(R.clause_reviews(rows).select("seq", "review_id", "place_name", "clauses"))


#: A connector that needs no mark and one that does, for six languages.
CONNECTORS = {"fr": ("bien que", "cependant"), "de": ("obwohl", "jedoch"), "es": ("pero", "sin embargo"), "it": ("però", "tuttavia"), "pt": ("porém", "contudo"), "nl": ("hoewel", "echter")}


def _clauses_in(lang: str, kind: int) -> str:
    opener, after = CONNECTORS[lang]
    plain = _CLAUSES.replace("' but '", f"' {opener} '").replace("', however '", f"', {after} '").replace("FROM documents)", f"FROM documents WHERE doc_id % 6 = {kind})")
    plain = plain.replace(_OPENERS_EN, re.sub(r"\(\?!.*?\)", "", X.OPENERS[lang])).replace(_AFTER_EN, re.sub(r"\(\?!.*?\)", "", X.AFTER_MARK[lang]))
    return f"({plain} SELECT doc_id, '{lang}' AS lang, CAST(len(flatten(k)) AS INTEGER) AS n, array_to_string(flatten(k), '|') AS clauses FROM k)"


@query(" UNION ALL ".join(_clauses_in(lang, i) for i, lang in enumerate(CONNECTORS)))
def clause_cases(spark, d):
    rows = table(spark, d, "documents")
    lang, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (code, (opener, after)) in enumerate(CONNECTORS.items()):
        mine = F.col("doc_id") % 6 == i
        lang = F.when(mine, code).otherwise(lang)
        text = F.when(mine, F.translate(F.replace(F.replace(F.col("text"), F.lit(" of "), F.lit(f" {opener} ")), F.lit(" and "), F.lit(f", {after} ")), "()", "  ")).otherwise(text)
    found = rows.select("doc_id", lang.alias("lang"), text.alias("t")).withColumn("c", X.split_clauses(F.col("t"), F.col("lang"), 1))
    return found.select("doc_id", "lang", F.size("c").alias("n"), F.array_join(F.transform("c", lambda c: c["text"]), "|").alias("clauses"))


_ISSUE = "list_filter(list_distinct(regexp_extract_all(lower({}), '[a-z'']+')), lambda w: NOT list_contains(" + quoted(X.ISSUE_STOPWORDS) + ", w))"
_PLACE = ("list_filter(list_distinct(string_split_regex(regexp_replace(regexp_replace(lower({}), '[^a-z0-9 ]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'), ' +')), "
          "lambda w: length(w) > 2 AND NOT list_contains(" + quoted(X.PLACE_STOPWORDS) + ", w))")


@query(f"SELECT doc_id, CAST(len({_ISSUE.format('text')}) AS INTEGER) AS issue_tokens, CAST(len({_PLACE.format('text')}) AS INTEGER) AS place_tokens FROM documents")
def token_counts(spark, d):
    return table(spark, d, "documents").select(
        "doc_id", F.size(X.issue_tokens(F.col("text"))).alias("issue_tokens"), F.size(X.place_tokens(F.col("text"))).alias("place_tokens"))


@query("SELECT vec_id, CAST(CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 6) AS BIGINT) % 360 AS INTEGER) AS hue FROM embeddings")
def hue(spark, d):
    return table(spark, d, "embeddings").select("vec_id", X.hue(F.col("vec_id")).alias("hue"))


@query("""SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#x27;')) AS escaped FROM pages""")
def html_escape(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(X.html_escape(F.col("html"))).alias("escaped"))


# ---- clauses and sentiment -------------------------------------------------


@query(f"SELECT min(doc_id) AS doc_id, arg_min(lang, doc_id) AS lang FROM documents WHERE {STRIP.format('text')} <> '' GROUP BY {STRIP.format('text')}")
def dedup_first(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("doc_id").alias("seq"), F.lit(0).alias("pos"), "lang", "text")
    return R.first_occurrences(rows).select("doc_id", "lang")


@query(ORACLE_SQL["dedup_first"])
def stream_first_texts(spark, d):
    """The documents as a stream of files; the state at its end."""
    path, files = fresh(spark, "stream-end"), table(spark, d, "documents")
    stream = spark.readStream.schema(files.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/documents.parque[t]")  # a pattern may match a file as well as a folder
    rows = stream.select("doc_id", F.col("doc_id").alias("seq"), F.lit(0).alias("pos"), "lang", "text")
    query_ = first_clauses(rows).writeStream.outputMode("complete").option("checkpointLocation", fresh(spark, "stream-state")).foreachBatch(
        lambda batch, _: batch.write.mode("overwrite").parquet(path)).trigger(availableNow=True).start()
    query_.awaitTermination()
    return spark.read.parquet(path).select("doc_id", "lang")


_STARS = "CAST(turn % 6 AS VARCHAR) || ' stars'"
_MOOD = "CASE WHEN turn % 6 IN (1, 2) THEN 'negative' WHEN turn % 6 IN (4, 5) THEN 'positive' ELSE 'neutral' END"


def _scored(spark, d):
    return table(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("review_id"), F.col("conv_id").alias("seq"), F.col("turn").alias("pos"), F.col("role").alias("place_name"),
        F.concat_ws("_c", "conv_id", "turn").alias("clause_id"), "text", F.col("turn").cast("int").alias("sentence_no"), (F.col("turn") / 7).alias("score"),
        R.sentiment_of(F.concat((F.col("turn") % 6).cast("string"), F.lit(" stars"))).alias("sentiment"))


@query(f"SELECT {_MOOD} AS sentiment, count(*) AS n FROM conversations GROUP BY 1")
def sentiment_dist(spark, d):
    return R.sentiment_distribution(_scored(spark, d))


@query(f"""SELECT {_MOOD} AS sentiment, CAST(conv_id AS VARCHAR) AS review_id, arg_min(role, turn) AS place_name,
    string_agg(conv_id || '_c' || turn, ',' ORDER BY turn) AS clauses, CAST(sum(CAST(round_even(turn / 7, 4) * 10000 AS BIGINT)) AS BIGINT) AS score
    FROM conversations GROUP BY 1, 2""")
def sentiment_nest(spark, d):
    n = R.nest_by_review(_scored(spark, d))
    return n.select("sentiment", F.col("review_key").alias("review_id"), "place_name", F.array_join(F.transform("clauses", lambda c: c["clause_id"]), ",").alias("clauses"),
                    F.aggregate("clauses", F.lit(0).cast("long"), lambda s, c: s + F.round(c["score"] * 10000).cast("long")).alias("score"))


@query("SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS pos, turn, role FROM conversations")
def flatten_clauses(spark, d):
    nested = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("clauses"))
    return R.flatten(nested)


@query("SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS section, role || ' ' || turn AS header, "
       r"regexp_replace(regexp_replace(text, '(^|\n)#', '\1*', 'g'), '^\s+|\s+$', '', 'g') AS body FROM conversations WHERE text <> ''")
def md_sections(spark, d):
    piece = F.concat(F.lit("## "), "role", F.lit(" "), F.col("turn").cast("string"), F.lit("\n\n# note\n"), F.regexp_replace("text", r"(^|\n)#", "$1*"))
    docs = table(spark, d, "conversations").where("text <> ''").groupBy(F.col("conv_id").alias("doc")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", piece.alias("t")))), lambda x: x["t"]), "\n\n").alias("text"))
    return R.sections(docs).select(F.col("doc").alias("conv_id"), "section", "header", "body")


# ---- near duplicates and arrays --------------------------------------------

_JAC = "(CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0 ELSE len(list_intersect({a}, {b}))::DOUBLE / len(list_distinct(list_concat({a}, {b}))) END)"
_LISTS = "WITH c AS (SELECT conv_id, list(text ORDER BY turn) AS texts FROM conversations GROUP BY conv_id)"


def _lists(spark, d):
    return table(spark, d, "conversations").groupBy("conv_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]).alias("texts"))


@query(_LISTS + f""", m AS (SELECT conv_id, list_reduce(list_transform(texts, lambda t: [t]), lambda acc, x:
    CASE WHEN len(list_filter(acc, lambda k: {_JAC.format(a=_ISSUE.format('k'), b=_ISSUE.format('x[1]'))} >= 0.45)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM c)
    SELECT conv_id, CAST(len(kept) AS INTEGER) AS n, md5(array_to_string(kept, '|')) AS kept FROM m""")
def near_dup_merge(spark, d):
    kept = A.merge_near_duplicates(F.col("texts"))
    return _lists(spark, d).withColumn("k", kept).select("conv_id", F.size("k").alias("n"), F.md5(F.array_join("k", "|")).alias("kept"))


@query(f"""WITH t AS (SELECT role, conv_id * 1000 + turn AS pos, text, {_ISSUE.format('text')} AS t FROM conversations),
    c AS (SELECT role, list({{'pos': pos, 't': t}} ORDER BY pos) AS l FROM t GROUP BY role),
    m AS (SELECT role, list_reduce(list_transform(l, lambda x: [x]), lambda acc, x:
        CASE WHEN len(list_filter(acc, lambda k: {_JAC.format(a='k.t', b='x[1].t')} >= 0.45)) > 0 THEN acc ELSE list_concat(acc, x) END) AS kept FROM c)
    SELECT role, CAST(unnest(list_transform(kept, lambda k: k.pos)) AS BIGINT) AS pos FROM m""")
def ordered_merge(spark, d):
    rows = table(spark, d, "conversations").select(F.col("role").alias("list"), (F.col("conv_id") * 1000 + F.col("turn")).alias("pos"), "text")
    return merge_ordered(rows).select(F.col("list").alias("role"), "pos")


@query(f"""WITH p AS (SELECT conv_id, turn, {_ISSUE.format('text')} AS t FROM conversations),
    q AS (SELECT *, lag(t) OVER (PARTITION BY conv_id ORDER BY turn) AS u FROM p)
    SELECT conv_id, turn, round({_JAC.format(a='t', b='u')}, 9) AS jaccard FROM q WHERE u IS NOT NULL""")
def jaccard_neighbours(spark, d):
    rows = table(spark, d, "conversations").select("conv_id", "turn", X.issue_tokens(F.col("text")).alias("t"))
    rows = rows.withColumn("u", F.lag("t").over(Window.partitionBy("conv_id").orderBy("turn"))).where("u is not null")
    return rows.select("conv_id", "turn", F.round(A.jaccard(F.col("t"), F.col("u")), 9).alias("jaccard"))


@query(_LISTS + """ SELECT conv_id, CAST(i AS INTEGER) AS part, CAST(len(texts[i * 3 + 1 : i * 3 + 3]) AS INTEGER) AS n,
    array_to_string(list_transform(texts[i * 3 + 1 : i * 3 + 3], lambda t: t[1:20]), '|') AS head
    FROM c, range(0, (len(texts) + 2) // 3) AS r(i)""")
def chunk_lists(spark, d):
    parts = _lists(spark, d).select("conv_id", F.posexplode(A.chunk(F.col("texts"), 3)).alias("part", "c"))
    return parts.select("conv_id", "part", F.size("c").alias("n"), F.array_join(A.prompt_sample(F.col("c"), 12, 20), "|").alias("head"))


@query("""WITH r AS (SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS r, count(*) OVER (PARTITION BY label) AS n FROM embeddings),
    j AS (SELECT label AS l, CAST(floor(j * ((n - 1) / 9::DOUBLE)) AS BIGINT) AS r FROM (SELECT DISTINCT label, n FROM r WHERE n > 10), range(0, 10) AS x(j))
    SELECT vec_id, label AS cluster FROM r WHERE n <= 10 OR EXISTS (SELECT 1 FROM j WHERE l = label AND j.r = r.r)""")
def even_subsample(spark, d):
    return C.even_subsample(table(spark, d, "embeddings").select("vec_id", F.col("vec_id").alias("seq"), F.col("label").alias("cluster")), 10).select("vec_id", "cluster")


# ---- vectors ---------------------------------------------------------------

_UNIT = """u AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))) AS v
    FROM embeddings)"""


def _vectors(spark, d):
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("seq"), F.col("label").alias("cluster"), "embedding")


@query(f"WITH {_UNIT} SELECT a.vec_id, round(list_dot_product(a.v, b.v), 9) AS similarity FROM u a, u b WHERE b.vec_id = 0 ORDER BY list_dot_product(a.v, b.v) DESC, a.vec_id LIMIT 15")
def cosine_topk(spark, d):
    rows = C.unit_vectors(_vectors(spark, d))
    q = rows.where("seq = 0").select("embedding").first()["embedding"]  # one row
    return C.nearest(rows, q).select(F.col("seq").alias("vec_id"), F.round("similarity", 9).alias("similarity"))


@query(f"WITH {_UNIT} SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v), 6) AS similarity FROM u a JOIN u b ON a.vec_id < b.vec_id AND list_dot_product(a.v, b.v) > 0.4")
def sim_pairs(spark, d):
    return C.similar_pairs(_vectors(spark, d), 0.6).select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"""WITH RECURSIVE {_UNIT}, e AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) > 0.4),
    r(s, t) AS (SELECT vec_id, vec_id FROM u UNION SELECT r.s, e.b FROM r JOIN e ON r.t = e.a)
    SELECT s AS vec_id, min(t) AS component FROM r GROUP BY s""")
def sim_components(spark, d):
    rows = _vectors(spark, d)
    return C.components(rows, C.similar_links(rows, 0.6)).select(F.col("seq").alias("vec_id"), "component")


@query()
def cluster_blocks(spark, d):
    rows = _vectors(spark, d)
    members = C.clusters(rows, 0.6).join(rows.select("seq", F.concat(F.lit("clause "), "seq").alias("text"), F.concat(F.lit("place "), "cluster").alias("place")), "seq")
    return C.blocks(members)


@query("""WITH g AS (SELECT label, list('clause ' || vec_id ORDER BY vec_id) AS clauses, list_sort(list_distinct(list('place ' || vec_id % 3))) AS places, count(*) AS size, min(vec_id) AS first
        FROM embeddings GROUP BY label HAVING count(*) >= 3)
    SELECT CAST(row_number() OVER (ORDER BY size DESC, first) AS INTEGER) AS cluster_id, array_to_string(clauses, '|') AS clauses, array_to_string(places, '|') AS place_names, CAST(size AS INTEGER) AS size FROM g""")
def label_blocks(spark, d):
    members = _vectors(spark, d).select("seq", "cluster", F.concat(F.lit("clause "), "seq").alias("text"), F.concat(F.lit("place "), F.col("seq") % 3).alias("place"))
    return C.blocks(members).withColumns({c: F.array_join(c, "|") for c in ("clauses", "place_names")})


_CENTROID = f"""{_UNIT}, x AS (SELECT label, i, avg(v[i]) AS x FROM u, range(1, 65) AS r(i) GROUP BY 1, 2),
    n AS (SELECT label, sqrt(sum(x * x)) AS n FROM x GROUP BY 1), c AS (SELECT label, list(x / n ORDER BY i) AS c FROM x JOIN n USING (label) GROUP BY 1)"""


@query(f"WITH {_CENTROID} SELECT label AS cluster, CAST(i - 1 AS INTEGER) AS pos, round(c[i], 9) AS x FROM c, range(1, 65) AS r(i)")
def centroids(spark, d):
    return C.centroids(_vectors(spark, d)).select("cluster", F.posexplode("centroid").alias("pos", "x")).withColumn("x", F.round("x", 9))


@query(f"WITH {_UNIT} SELECT a.label AS cluster, round(avg(list_dot_product(a.v, b.v)), 8) AS cohesion FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id GROUP BY 1")
def cohesion(spark, d):
    return C.cohesion(_vectors(spark, d)).withColumn("cohesion", F.round("cohesion", 8))


@query(f"WITH {_CENTROID} SELECT a.label AS cluster, round(greatest(max(list_dot_product(a.c, b.c)), 0), 8) AS separation FROM c a JOIN c b ON a.label <> b.label GROUP BY 1")
def separation(spark, d):
    return C.separation(_vectors(spark, d)).withColumn("separation", F.round("separation", 8))


@query("""WITH s AS (SELECT label, count(*) AS size FROM embeddings GROUP BY 1 HAVING count(*) >= 3), t AS (SELECT count(*) AS n FROM embeddings)
    SELECT count(*) AS blocks, CAST(sum(size) AS BIGINT) AS kept, sum(size) / max(n) AS kept_share, CAST(max(n) - sum(size) AS BIGINT) AS dropped, 1 - sum(size) / max(n) AS drop_rate FROM s, t""")
def size_summary(spark, d):
    rows = table(spark, d, "embeddings")
    return C.size_summary(rows.groupBy("label").agg(F.count("*").alias("size")).where("size >= 3"), rows.count())


# ---- model replies ---------------------------------------------------------

_SAY = "'\"' || lang || ' ' || doc_id || '\"'"
_RAW = f"""CASE doc_id % 6 WHEN 0 THEN '{{"issues":[{{"issue":' || {_SAY} || ',"importance":' || n_chars / 100.0 || '}},{{"issue":" ","importance":3}}]}}'
    WHEN 1 THEN 'Sure:' || chr(10) || '```json' || chr(10) || '{{"issues":[{{"issue":' || {_SAY} || ',"importance":"2.5"}}]}}' || chr(10) || '```' || chr(10) || 'bye'
    WHEN 2 THEN 'no json, ' || lang WHEN 3 THEN 'x {{"issues":[{{"issue":' || {_SAY} || ',"importance":11}},{{"issue":"Noise","importance":"x"}},{{"issue":"Staff"}}]}} y'
    WHEN 4 THEN '{{"issues":[]}}' ELSE '{{"issues":[{{"issue":' || {_SAY} || ',"importance":-1}},{{"issue":"B","importance":' || (doc_id % 9 + 0.5) || '}}]}}' END"""


@query(f"""WITH r AS (SELECT doc_id, {_RAW} AS raw FROM documents),
    b AS (SELECT doc_id, regexp_extract(CASE WHEN contains(raw, '```') THEN string_split(raw, '```')[2] ELSE raw END, '(?s)\\{{.*\\}}') AS body FROM r),
    i AS (SELECT doc_id, unnest(json_transform(body, '{{"issues":[{{"issue":"VARCHAR","importance":"VARCHAR"}}]}}').issues) AS x FROM b WHERE body <> '')
    SELECT doc_id, trim(x.issue) AS issue, CAST(greatest(0, least(10, round_even(coalesce(try_cast(x.importance AS DOUBLE), 0), 0))) AS INTEGER) AS importance
    FROM i WHERE trim(x.issue) <> ''""")
def llm_json_parse(spark, d):
    say = F.concat(F.lit('{"issues":[{"issue":"'), "lang", F.lit(" "), "doc_id", F.lit('","importance":'))
    kind = F.col("doc_id") % 6
    raw = (F.when(kind == 0, F.concat(say, (F.col("n_chars") / 100).cast("string"), F.lit('},{"issue":" ","importance":3}]}')))
           .when(kind == 1, F.concat(F.lit("Sure:\n```json\n"), say, F.lit('"2.5"}]}\n```\nbye'))).when(kind == 2, F.concat(F.lit("no json, "), "lang"))
           .when(kind == 3, F.concat(F.lit("x "), say, F.lit('11},{"issue":"Noise","importance":"x"},{"issue":"Staff"}]} y'))).when(kind == 4, F.lit('{"issues":[]}'))
           .otherwise(F.concat(say, F.lit('-1},{"issue":"B","importance":'), (F.col("doc_id") % 9 + 0.5).cast("string"), F.lit("}]}"))))
    return table(spark, d, "documents").select("doc_id", F.explode(J.parse_issues(raw)).alias("x")).select("doc_id", "x.issue", "x.importance")


def named_issues(prompt: str) -> str:
    """A provider whose replies follow from the prompt alone: each clause is an issue of its first letters."""
    found = [c[:24] for c in prompt.split("\n- ")[1:]]
    return "Here:\n```json\n" + json.dumps({"issues": [{"issue": c, "importance": len(c.split(" ")[0])} for c in found]}) + "\n```"


_MERGED = """list_reduce(list_transform({list}, lambda t: [t]), lambda acc, x:
    CASE WHEN len(list_filter(acc, lambda k: {jac} >= 0.45)) > 0 THEN acc ELSE list_concat(acc, x) END)""".replace("{jac}", _JAC.format(a=_ISSUE.format("k"), b=_ISSUE.format("x[1]")))


@query(_LISTS + f""", m AS (SELECT conv_id, {_MERGED.replace('{list}', 'texts')} AS kept FROM c),
    i AS (SELECT conv_id, len(kept) AS n, list_filter(list_transform(kept, lambda t: {{'issue': trim(t[1:24], ' '), 'importance': least(10, length(string_split(t[1:24], ' ')[1]))}}), lambda x: x.issue <> '') AS a FROM m),
    k AS (SELECT conv_id, n, a, CASE WHEN len(a) = 0 THEN [] ELSE {_MERGED.replace('{list}', 'list_transform(a, lambda x: x.issue)')} END AS kept FROM i),
    s AS (SELECT conv_id, n, list_transform(kept, lambda t, i: {{'o': -round_even(list_avg(list_transform(list_filter(a, lambda x: x.issue = t), lambda x: x.importance)), 0), 'i': i, 'issue': t}}) AS s FROM k)
    SELECT conv_id AS cluster_id, CAST(n AS INTEGER) AS clause_count, array_to_string(list_transform(list_sort(s), lambda x: x.issue || ':' || CAST(-x.o AS INTEGER)), '|') AS issues FROM s""")
def knowledge_base(spark, d):
    blocks = _lists(spark, d).select(F.col("conv_id").alias("cluster_id"), F.col("texts").alias("clauses"))
    ledger = Ledger(spark, fresh(spark, "ledger"), named_issues, model="named", every=2000)
    return KB.knowledge_base(blocks, ledger, size=4).select(
        "cluster_id", "clause_count", F.array_join(F.transform("issues", lambda x: F.concat_ws(":", x["issue"], x["importance"].cast("string"))), "|").alias("issues"))


# ---- taxonomy --------------------------------------------------------------

_COARSE = "(VALUES " + ", ".join("({}, '{}', '{}')".format(i, k, t.replace("'", "''")) for i, (k, t) in enumerate(T.COARSE)) + ") AS c(ord, category, category_label)"
_FINE = "(VALUES " + ", ".join("({}, '{}', '{}', '{}', '{}')".format(*r) for r in T.fine_rows()) + ") AS f(ord, group_id, group_label, subcategory_key, subcategory_label)"


@query(f"""SELECT category, category_label, CAST(count(*) AS INTEGER) AS block_count, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS blocks
    FROM part JOIN {_COARSE} ON p_partkey % 21 = ord GROUP BY 1, 2""")
def taxonomy_report(spark, d):
    dim = T.coarse_dim(spark)
    rows = table(spark, d, "part").withColumn("ord", F.col("p_partkey") % 21).join(dim.select("ord", "category"), "ord").select(
        F.col("p_partkey").alias("cluster_id"), "category", F.col("p_name").alias("block_name"), F.col("p_size").alias("size"))
    return T.report(rows, dim).withColumn("blocks", F.array_join(F.transform("blocks", lambda b: b["cluster_id"].cast("string")), ","))


@query(f"""WITH k AS (SELECT p_partkey, CASE WHEN p_partkey % 80 < 75 THEN CAST(p_partkey % 80 AS VARCHAR) END AS o FROM part)
    SELECT coalesce(group_id, 'residual') AS group_id, coalesce(group_label, 'residual') AS group_label, CAST(count(*) AS INTEGER) AS block_count,
    string_agg(CAST(p_partkey AS VARCHAR) || coalesce(subcategory_label, 'Unknown: zzz'), ',' ORDER BY p_partkey) AS blocks
    FROM k LEFT JOIN {_FINE} ON o = CAST(ord AS VARCHAR) GROUP BY 1, 2""")
def fine_report(spark, d):
    dim = T.fine_dim(spark)
    rows = table(spark, d, "part").withColumn("ord", F.col("p_partkey") % 80).join(dim.select("ord", "subcategory_key"), "ord", "left").select(
        F.col("p_partkey").alias("cluster_id"), F.coalesce("subcategory_key", F.lit("zzz")).alias("subcategory_key"), F.col("p_name").alias("block_name"), F.col("p_size").alias("size"))
    return T.fine_report(rows, dim).withColumn("blocks", F.array_join(F.transform("blocks", lambda b: F.concat(b["cluster_id"].cast("string"), b["subcategory_label"])), ","))


def _part(spark, d):
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("cluster_id"), F.col("p_brand").alias("grp"), F.col("p_type").alias("sub"), F.col("p_type").alias("sub_label"),
        F.col("p_name").alias("block_name"), F.col("p_size").alias("size"), F.array("p_brand", "p_type").alias("place_names"))


@query("SELECT p_brand AS grp, p_type AS sub, count(*) AS block_count, CAST(sum(p_size) AS BIGINT) AS clause_total FROM part GROUP BY ROLLUP (p_brand, p_type)")
def drilldown_rollup(spark, d):
    return T.rollup(_part(spark, d))


@query("""WITH s AS (SELECT p_brand, p_type, sum(p_size) AS t, count(*) AS n, string_agg(CAST(p_partkey AS VARCHAR), ' ' ORDER BY p_size DESC, p_partkey) AS b FROM part GROUP BY 1, 2)
    SELECT p_brand AS grp, CAST(sum(n) AS BIGINT) AS block_count, CAST(sum(t) AS BIGINT) AS clause_total, string_agg(p_type || '=' || b, ',' ORDER BY t DESC, p_type) AS subs FROM s GROUP BY 1""")
def drill_down(spark, d):
    inner = lambda s: F.concat_ws("=", s["sub"], F.array_join(F.transform(s["blocks"], lambda b: b["cluster_id"].cast("string")), " "))
    return T.drill_down(_part(spark, d)).select("grp", "block_count", "clause_total", F.array_join(F.transform("subcategories", inner), ",").alias("subs"))


@query("SELECT CASE WHEN p_brand IN ('Brand#11', 'Brand#22', 'Brand#33') THEN p_brand ELSE 'other' END AS key, count(*) AS n FROM part GROUP BY 1")
def residual_coerce(spark, d):
    return table(spark, d, "part").groupBy(T.valid_key(F.col("p_brand"), ["Brand#11", "Brand#22", "Brand#33"]).alias("key")).agg(F.count("*").alias("n"))


_ECHO = "CASE doc_id % 5 WHEN 0 THEN category_label WHEN 1 THEN category WHEN 2 THEN ' ' || upper(category_label) || ' ' WHEN 3 THEN replace(category_label, '–', '-') ELSE source END"


@query(f"""WITH e AS (SELECT doc_id, lower(trim({_ECHO}, ' ')) AS said FROM documents JOIN {_COARSE} ON doc_id % 21 = ord)
    SELECT doc_id, coalesce(category, 'other') AS category FROM e LEFT JOIN {_COARSE} ON said = category OR said = replace(lower(category_label), '–', '-')""")
def coarse_category(spark, d):
    dim = T.coarse_dim(spark)
    rows = table(spark, d, "documents").withColumn("ord", F.col("doc_id") % 21).join(dim, "ord")
    kind = F.col("doc_id") % 5
    said = (F.when(kind == 0, F.col("category_label")).when(kind == 1, F.col("category")).when(kind == 2, F.concat(F.lit(" "), F.upper("category_label"), F.lit(" ")))
            .when(kind == 3, F.translate("category_label", "–", "-")).otherwise(F.col("source")))
    return rows.select("doc_id", T.coarse_category(said).alias("category"))


@query("SELECT o_orderkey AS cluster_id, o_totalprice FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)")
def anti_cache(spark, d):
    cache = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("cluster_id"))
    return T.not_cached(table(spark, d, "orders").select(F.col("o_orderkey").alias("cluster_id"), "o_totalprice"), cache)


# ---- KPIs ------------------------------------------------------------------


@query("SELECT CAST(sum(p_size) AS BIGINT) AS clauses, count(*) AS blocks FROM part")
def kpi_volume(spark, d):
    return K.volume(_part(spark, d))


@query("""WITH r AS (SELECT p_size AS s, row_number() OVER (ORDER BY p_size) AS i, row_number() OVER (ORDER BY p_size DESC) AS k, count(*) OVER () AS n FROM part)
    SELECT CAST(min(s) AS BIGINT) AS min_size, CAST(max(s) AS BIGINT) AS max_size, avg(s) AS mean_size,
    round(2 * sum(s * i) / (max(n) * sum(s)) - (max(n) + 1) / max(n), 9) AS gini,
    round(sum(CASE WHEN k <= ceil(n * 0.1) THEN s ELSE 0 END) / sum(s), 9) AS top_share, median(s) AS median_size FROM r""")
def kpi_concentration(spark, d):
    return K.concentration(_part(spark, d)).withColumns({"gini": F.round("gini", 9), "top_share": F.round("top_share", 9)})


@query("SELECT place, count(*) AS blocks, CAST(sum(p_size) AS BIGINT) AS clauses FROM (SELECT p_brand AS place, p_size FROM part UNION ALL SELECT p_type, p_size FROM part) GROUP BY 1")
def kpi_per_place(spark, d):
    return K.per_place(_part(spark, d))


@query("SELECT round(avg(n), 9) AS avg_places FROM (SELECT count(DISTINCT l_quantity) AS n FROM lineitem GROUP BY l_orderkey)")
def kpi_places_per_block(spark, d):
    blocks = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_quantity").alias("place_names"))
    return K.places_per_block(blocks).withColumn("avg_places", F.round("avg_places", 9))


_ISSUES = "(SELECT l_orderkey AS cluster_id, l_returnflag || l_linestatus AS issue, CAST(l_quantity AS INTEGER) % 11 AS importance, l_linenumber AS clause_count FROM lineitem)"


def _issues(spark, d):
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("cluster_id"), F.concat("l_returnflag", "l_linestatus").alias("issue"), (F.col("l_quantity").cast("int") % 11).alias("importance"), F.col("l_linenumber").alias("clause_count"))


@query(f"SELECT cluster_id, round(avg(importance), 9) AS mean_severity, round(avg(importance) * max(clause_count), 9) AS weighted_volume, count(DISTINCT issue) AS diversity FROM {_ISSUES} GROUP BY 1")
def kpi_severity(spark, d):
    return K.severity(_issues(spark, d)).withColumns({c: F.round(c, 9) for c in ("mean_severity", "weighted_volume")})


@query(f"SELECT cluster_id, issue, importance, clause_count FROM {_ISSUES} ORDER BY importance DESC, issue, cluster_id, clause_count LIMIT 10")
def kpi_top_issues(spark, d):
    return K.top_issues(_issues(spark, d), 10)


@query(f"SELECT issue, round(count(DISTINCT cluster_id) * avg(importance), 6) AS priority FROM {_ISSUES} GROUP BY 1")
def kpi_severity_frequency(spark, d):
    return K.severity_frequency(_issues(spark, d)).withColumn("priority", F.round("priority", 6))


@query("SELECT p_brand AS grp, count(*) AS n, count(*) / (SELECT count(*) FROM part) AS share FROM part GROUP BY 1")
def kpi_mix(spark, d):
    return K.mix(_part(spark, d), "grp")


@query("SELECT round(sum((n / t) ^ 2), 12) AS hhi FROM (SELECT count(*) AS n, sum(count(*)) OVER () AS t FROM part GROUP BY p_brand)")
def kpi_hhi(spark, d):
    return K.hhi(_part(spark, d), "grp").withColumn("hhi", F.round("hhi", 12))


@query("SELECT avg(CASE WHEN p_brand = 'Brand#11' THEN 1.0 ELSE 0.0 END)::DOUBLE AS residual_rate FROM part")
def kpi_residual_rate(spark, d):
    return K.residual_rate(_part(spark, d), "grp", "Brand#11")


@query("SELECT p_brand AS grp, p_type AS sub, count(*) AS n, CAST(min(p_size) AS BIGINT) AS min_size, CAST(max(p_size) AS BIGINT) AS max_size, avg(p_size) AS mean_size FROM part GROUP BY 1, 2")
def kpi_sizes_in_group(spark, d):
    return K.sizes_in_group(_part(spark, d), "grp", "sub")


_BALANCE = """WITH x AS (SELECT {by} AS k, count(*) FILTER ({neg}) AS neg, count(*) FILTER ({pos}) AS pos FROM {t} GROUP BY 1)
    SELECT k AS {name}, neg, pos, CASE WHEN pos > 0 THEN neg / pos END AS ratio, neg / (neg + pos) AS neg_share, (pos - neg) / (neg + pos) AS net FROM x WHERE neg + pos > 0"""


@query(_BALANCE.format(by="source", neg="toxic = 1", pos="toxic = 0 AND quality = 1", t="documents JOIN labels USING (doc_id)", name="place_name"))
def kpi_balance_place(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.col("source").alias("place_name")).join(table(spark, d, "labels"), "doc_id")
    return K.balance(rows.where("toxic = 1"), rows.where("toxic = 0 and quality = 1"), "place_name")


@query(_BALANCE.format(by="CAST(date_trunc('day', ts) AS DATE)", neg="value < 20", pos="value > 30", t="events", name="day"))
def kpi_balance_time(spark, d):
    rows = table(spark, d, "events").withColumn("day", F.to_date(F.date_trunc("day", "ts")))
    return K.balance(rows.where("value < 20"), rows.where("value > 30"), "day")


# ---- keyword retrieval -----------------------------------------------------

KEYWORDS = ["license", "Idiot", "thand", "ción", "ung"]
PLACES = [(1, "Than Ering Beach"), (2, "The Eaed House"), (3, "Tion Farm"), (4, "Ering Than"), (5, "The Old House")]
_PLACES = "(VALUES " + ", ".join(f"({i}, '{p}')" for i, p in PLACES) + ") AS p(seq, place)"


def _places(spark):
    return spark.createDataFrame(PLACES, "seq long, place string")


@query("SELECT doc_id, CASE " + " ".join(f"WHEN contains(lower(text), '{k.lower()}') THEN '{k}'" for k in KEYWORDS) + " END AS keyword FROM documents")
def keyword_match_first(spark, d):
    return table(spark, d, "documents").select("doc_id", JN.first_keyword(F.col("text"), KEYWORDS).alias("keyword"))


@query(f"""SELECT DISTINCT doc_id AS review_id, place FROM (SELECT doc_id, unnest({_PLACE.format('text')}) AS w FROM documents)
    JOIN (SELECT place, unnest({_PLACE.format('place')}) AS w FROM {_PLACES}) USING (w)""")
def place_overlap(spark, d):
    return JN.place_overlap(table(spark, d, "documents").select(F.col("doc_id").alias("review_id"), "text"), _places(spark))


@query(f"""SELECT CAST(min(p_partkey) AS BIGINT) AS seq FROM (SELECT p_partkey, list_sort({_PLACE.format("p_name || ' ' || p_brand")}) AS t FROM part) WHERE len(t) > 0 GROUP BY t""")
def distinct_places(spark, d):
    return JN.distinct_places(table(spark, d, "part").select(F.col("p_partkey").alias("seq"), F.concat_ws(" ", "p_name", "p_brand").alias("place"))).select("seq")


@query("""WITH k AS (SELECT item_id AS seq, substr(text, 1, 14) AS keyword FROM benchmark UNION ALL SELECT 100000 + row_number() OVER (ORDER BY lang), lang || 'e ' FROM (SELECT DISTINCT lang FROM documents)),
    m AS (SELECT doc_id, min(seq) AS seq FROM documents JOIN k ON contains(lower(text), lower(keyword)) GROUP BY 1)
    SELECT doc_id, keyword FROM documents LEFT JOIN m USING (doc_id) LEFT JOIN k USING (seq)""")
def keyword_table(spark, d):
    langs = table(spark, d, "documents").select("lang").distinct().select(
        (F.row_number().over(Window.orderBy("lang")) + 100000).cast("long").alias("seq"), F.concat("lang", F.lit("e ")).alias("keyword"))  # a row a language
    keys = table(spark, d, "benchmark").select(F.col("item_id").alias("seq"), F.substring("text", 1, 14).alias("keyword")).unionByName(langs)
    return first_of_keywords(table(spark, d, "documents"), keys).select("doc_id", "keyword")


_ROUTE_PLACES = "(SELECT p_name || ' ' || p_type AS place, min(p_partkey) AS seq FROM part GROUP BY 1)"
_PLAIN_PLACE = _PLACE.replace(quoted(X.PLACE_STOPWORDS), quoted(X.PLACE_STOPWORDS + X.GENERIC_PLACE_WORDS))
ROUTES = ["the red widget and the large ring", "economy ring", "no such words at all"]


@query(" UNION ALL ".join(f"""(WITH s AS (SELECT place, seq, {_PLAIN_PLACE.format('place')} AS t, {_PLACE.format("'" + q + "'")} AS q FROM {_ROUTE_PLACES}),
    o AS (SELECT place, seq, len(t) AS n, len(q) AS m, len(list_intersect(t, q)) AS overlap FROM s WHERE len(t) > 0)
    SELECT {i} AS i, place FROM o WHERE overlap > 0 AND overlap / m >= 0.25 ORDER BY overlap DESC, overlap / n DESC, seq LIMIT 1)""" for i, q in enumerate(ROUTES)))
def route_query(spark, d):
    places = table(spark, d, "part").groupBy(F.concat_ws(" ", "p_name", "p_type").alias("place")).agg(F.min("p_partkey").alias("seq"))
    found = [JN.route_query(q, places).select(F.lit(i).alias("i"), "place") for i, q in enumerate(ROUTES)]
    return found[0].unionByName(found[1]).unionByName(found[2])


def _rated(spark, d):
    rating = F.when(F.col("quality") == 1, 4.0).when(F.col("quality") == 0, 2.0).otherwise(float("nan"))
    return table(spark, d, "documents").join(table(spark, d, "labels").select("doc_id", "quality"), "doc_id", "left").select(
        F.col("doc_id").alias("review_id"), F.col("doc_id").alias("seq"), "text", rating.alias("rating"), F.lpad(F.col("n_chars").cast("string"), 8, "0").alias("date"))


_RATED = "r AS (SELECT doc_id, text, CASE WHEN quality = 1 THEN 4.0 WHEN quality = 0 THEN 2.0 ELSE 3.0 END AS rating, lpad(CAST(n_chars AS VARCHAR), 8, '0') AS date FROM documents LEFT JOIN labels USING (doc_id))"
_Q = _PLACE.format("'thand ering eaed'")


@query(f"""WITH {_RATED}, s AS (SELECT doc_id, rating, CAST(len(list_intersect({_PLACE.format('text')}, {_Q})) AS INTEGER) AS overlap FROM r)
    SELECT doc_id AS review_id, overlap FROM s WHERE overlap > 0 ORDER BY overlap DESC, rating, doc_id LIMIT 15""")
def global_search(spark, d):
    return JN.global_search("thand ering eaed", _rated(spark, d)).select("review_id", "overlap")


@query(f"WITH {_RATED} SELECT doc_id AS review_id FROM r ORDER BY date DESC, doc_id LIMIT 15")
def global_search_newest(spark, d):
    return JN.global_search("the of", _rated(spark, d)).select("review_id")


@query(f"WITH {_RATED} SELECT doc_id AS review_id FROM r ORDER BY rating, date, doc_id LIMIT 15")
def cluster_topk(spark, d):
    return JN.worst_of_place(_rated(spark, d)).select("review_id")


_QUESTION = "CASE WHEN item_id % 5 = 0 THEN substr(text, 1, 40) || ' large ring' WHEN item_id % 5 = 1 THEN 'the of' ELSE substr(text, 1, 60) END"
_KNOWN = f"SELECT min_by(p_name || ' ' || p_type, p_partkey) AS place, min(p_partkey) AS seq FROM part GROUP BY list_sort({_PLACE.format(chr(112) + '_name || chr(32) || p_type')}) HAVING len(list_sort({_PLACE.format(chr(112) + '_name || chr(32) || p_type')})) > 0"


@query(f"""WITH {_RATED}, q AS (SELECT item_id, {_PLACE.format(_QUESTION)} AS t FROM benchmark), d AS (SELECT doc_id, rating, date, {_PLACE.format('text')} AS t FROM r),
    p AS ({_KNOWN}), pr AS (SELECT place, seq, {_PLACE.format('place')} AS t, {_PLAIN_PLACE.format('place')} AS u FROM p),
    o AS (SELECT item_id, place, seq, len(u) AS n, len(q.t) AS m, len(list_intersect(q.t, u)) AS overlap FROM q, pr WHERE len(u) > 0 AND len(list_intersect(q.t, u)) > 0),
    w AS (SELECT item_id, place FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY overlap DESC, overlap / n DESC, seq) AS k FROM o WHERE overlap / m >= 0.25) WHERE k = 1),
    l AS (SELECT item_id, place, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY rating, date, doc_id) AS rank FROM w JOIN pr USING (place) JOIN d ON list_has_any(d.t, pr.t)),
    z AS (SELECT * FROM q WHERE item_id NOT IN (SELECT item_id FROM l)),
    g AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY len(list_intersect(z.t, d.t)) DESC, rating, doc_id) AS rank FROM z JOIN d ON list_has_any(z.t, d.t)),
    e AS (SELECT item_id, doc_id, row_number() OVER (PARTITION BY item_id ORDER BY date DESC, doc_id) AS rank FROM z, d WHERE len(z.t) = 0)
    SELECT item_id AS question, CAST(rank AS INTEGER) AS rank, doc_id AS review_id, place FROM (SELECT item_id, rank, doc_id, place FROM l UNION ALL SELECT item_id, rank, doc_id, NULL FROM g UNION ALL SELECT item_id, rank, doc_id, NULL FROM e) WHERE rank <= 15""")
def questions_together(spark, d):
    path = fresh(spark, "review-index")
    places = table(spark, d, "part").groupBy(F.concat_ws(" ", "p_name", "p_type").alias("place")).agg(F.min("p_partkey").alias("seq"))
    write_review_index(_rated(spark, d), places, path)
    kind = F.col("item_id") % 5
    question = F.when(kind == 0, F.concat(F.substring("text", 1, 40), F.lit(" large ring"))).when(kind == 1, F.lit("the of")).otherwise(F.substring("text", 1, 60))
    return search_many(spark, path, table(spark, d, "benchmark").select(F.col("item_id").alias("question"), question.alias("text")))


@query("""SELECT coalesce(s_name, 'Review ' || i) AS location_name, 'r' || i AS judgement, CASE WHEN i % 2 = 0 THEN 'a; b' ELSE '' END AS action
    FROM range(0, 120, 7) AS t(i) LEFT JOIN supplier ON s_suppkey = i AND i > 0""")
def judge_lookup(spark, d):
    got = spark.range(0, 120, 7).select(
        F.col("id").cast("int").alias("index"), F.concat(F.lit("r"), "id").alias("reason"),
        F.when(F.col("id") % 2 == 0, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array().cast("array<string>")).alias("action_items"))
    return KB.judgement_rows(got, table(spark, d, "supplier").where("s_suppkey > 0").select(F.col("s_suppkey").alias("seq"), F.col("s_name").alias("location")))


@query("SELECT DISTINCT s AS location FROM (SELECT CASE WHEN n_nationkey % 4 = 0 THEN ' ' ELSE 'N' || n_regionkey END AS s FROM nation) WHERE trim(s) <> ''")
def locations(spark, d):
    return JN.locations(table(spark, d, "nation").select(F.when(F.col("n_nationkey") % 4 == 0, " ").otherwise(F.concat(F.lit("N"), "n_regionkey")).alias("location_name")))


@query("SELECT count(*) FILTER (source = 'src3') AS there, count(*) AS anywhere FROM documents")
def judgements_by_location(spark, d):
    rows = table(spark, d, "documents")
    return JN.at_location(rows, "src3", "source").agg(F.count("*").alias("there")).crossJoin(JN.at_location(rows).agg(F.count("*").alias("anywhere")))  # one row each


# ---- validation ------------------------------------------------------------

_SIZES = "(SELECT label AS cluster, count(*) AS size FROM embeddings GROUP BY 1)"


def _sizes(spark, d):
    return _vectors(spark, d).groupBy("cluster").agg(F.count("*").alias("size"))


@query(f"SELECT size, count(*) AS blocks FROM {_SIZES} GROUP BY 1")
def size_histogram(spark, d):
    return C.size_histogram(_sizes(spark, d))


@query(f"SELECT cluster, size FROM {_SIZES} ORDER BY size DESC, cluster LIMIT 5")
def largest_blocks(spark, d):
    return C.largest(_sizes(spark, d))


_CLOSE = "SELECT CAST(a.label AS BIGINT) AS a, CAST(b.label AS BIGINT) AS b, list_dot_product(a.c, b.c) AS s FROM {c} a JOIN {c} b ON a.label < b.label"


@query(f"WITH {_CENTROID}, p AS ({_CLOSE.format(c='c')}) SELECT a, b, round(s, 8) AS similarity FROM p WHERE s > 0.1")
def close_centroids(spark, d):
    return C.close_centroids(_vectors(spark, d), 0.1).withColumn("similarity", F.round("similarity", 8))


@query(f"""WITH {_CENTROID}, k AS (SELECT cluster, size FROM {_SIZES} WHERE size >= 3), ck AS (SELECT c.* FROM c JOIN k ON label = cluster),
    h AS (SELECT a.label, avg(list_dot_product(a.v, b.v)) AS h FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id JOIN k ON a.label = cluster GROUP BY 1),
    s AS (SELECT a.label, greatest(max(list_dot_product(a.c, b.c)), 0) AS s FROM ck a JOIN ck b ON a.label <> b.label GROUP BY 1),
    p AS ({_CLOSE.format(c='ck')}), t AS (SELECT count(*) AS n FROM embeddings)
    SELECT (SELECT count(*) FROM k) AS blocks, (SELECT CAST(sum(size) AS BIGINT) FROM k) AS kept, (SELECT n - CAST(sum(size) AS BIGINT) FROM k, t GROUP BY n) AS dropped,
    (SELECT round(min(h), 8) FROM h) AS min_cohesion, (SELECT round(max(h), 8) FROM h) AS max_cohesion, (SELECT round(avg(h), 8) FROM h) AS mean_cohesion,
    (SELECT round(avg(s), 8) FROM s) AS mean_separation, (SELECT round(avg(h), 7) FROM h) - (SELECT round(avg(s), 7) FROM s) AS gap, (SELECT count(*) FROM p WHERE s > 0.9) AS close_pairs""")
def validation_report(spark, d):
    one = C.validation_report(_vectors(spark, d))
    return one.drop("kept_share", "drop_rate").withColumn("gap", F.round("mean_cohesion", 7) - F.round("mean_separation", 7)).withColumns(
        {c: F.round(c, 8) for c in ("min_cohesion", "max_cohesion", "mean_cohesion", "mean_separation")})


# ---- counters and scores ---------------------------------------------------


@query("SELECT count(*) AS read, count(*) FILTER (text IS NOT NULL AND n_chars > 500) AS written, count(*) - count(*) FILTER (text IS NOT NULL AND n_chars > 500) AS skipped FROM documents")
def row_counts(spark, d):
    rows = table(spark, d, "documents")
    return R.row_counts(rows, rows.where("text is not null and n_chars > 500"))


@query(f"SELECT count(*) AS rows, count(*) FILTER (turn % 3 = 0 AND {STRIP.format('text')} <> '') AS swapped FROM conversations")
def swap_counts(spark, d):
    return JN.swap_counts(table(spark, d, "conversations").select(F.when(F.col("turn") % 3 == 0, F.concat(F.lit("  "), "text")).otherwise(" \n").alias("translated_content")))


@query("""WITH s AS (SELECT vec_id, list_transform(list_slice(embedding, 1, 5), lambda x: x::DOUBLE * 40) AS v FROM embeddings),
    e AS (SELECT vec_id, v, list_transform(v, lambda x: exp(x - list_max(v))) AS e FROM s)
    SELECT vec_id, list_position(v, list_max(v)) || ' stars' AS label, round(list_max(e) / list_sum(e), 9) AS score FROM e""")
def softmax_argmax(spark, d):
    scores = F.transform(F.slice("embedding", 1, 5), lambda x: x.cast("double") * 40)
    top = A.top_label(scores, [f"{k} stars" for k in range(1, 6)])
    return table(spark, d, "embeddings").withColumn("t", top).select("vec_id", "t.label", F.round("t.score", 9).alias("score"))


@query("SELECT vec_id, CASE WHEN vec_id = 0 THEN '#999999' ELSE 'hsl(' || (CAST('0x' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 6) AS BIGINT) % 360) || ',70%,50%)' END AS colour FROM embeddings")
def cluster_colour(spark, d):
    return table(spark, d, "embeddings").select("vec_id", X.colour(F.col("vec_id")).alias("colour"))


# ---- sources and sinks: written, read back and held against the tables -----


@query("SELECT coalesce(source, '') AS location_name, coalesce(text, '') AS judgement, coalesce(lang, '') AS action FROM documents")
def judgements_round_trip(spark, d):
    path = fresh(spark, "judgements")
    writers.judgements(table(spark, d, "documents").select(F.col("source").alias("location_name"), F.col("text").alias("judgement"), F.col("lang").alias("action")), path)
    return readers.judgements(spark, path)


@query("SELECT doc_id, coalesce(text, '') AS content, lang FROM documents")
def csv_replaced_in_place(spark, d):
    path = fresh(spark, "reviews")
    writers.csv(table(spark, d, "documents").select("doc_id", F.lit("old").alias("content"), F.col("text").alias("translated_content"), "lang"), path)
    swapped = readers.csv(spark, path).withColumn("content", F.col("translated_content")).select("doc_id", "content", "lang")
    writers.replace_csv(swapped, path)
    return readers.csv(spark, path).select(F.col("doc_id").cast("long").alias("doc_id"), "content", "lang")


@query("SELECT doc_id, CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS seq FROM documents WHERE doc_id % 3 <> 1")
def dense_numbers(spark, d):
    path = fresh(spark, "numbers")
    table(spark, d, "documents").select("doc_id").repartitionByRange(5, "doc_id").sortWithinPartitions("doc_id").withColumn(
        "seq", F.monotonically_increasing_id()).where("doc_id % 3 <> 1").write.parquet(path)
    return readers.dense(spark.read.parquet(path))


@query("""WITH l AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN [] ELSE [lang, 'c' || doc_id] END AS c FROM documents)
    SELECT CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS cluster_id, array_to_string(c, '|') AS clauses FROM l WHERE len(c) > 0""")
def block_lines(spark, d):
    path = fresh(spark, "blocks")
    texts = F.array("lang", F.concat(F.lit("c"), "doc_id"))
    line = F.when(F.col("doc_id") % 4 == 0, F.lit('{"cluster_id": 7, "clauses": []}')).when(F.col("doc_id") % 4 == 1, F.to_json(texts)).otherwise(
        F.to_json(F.struct(F.lit(7).alias("cluster_id"), texts.alias("items"))))
    table(spark, d, "documents").coalesce(1).sortWithinPartitions("doc_id").select(line.alias("value")).write.text(path)
    return readers.block_lines(spark, path).withColumn("clauses", F.array_join("clauses", "|"))


#: (line, clauses) by doc_id % 14: X stands for a string of the row, in the line and in its clauses.
SHAPES = [
    ('"X"', "X"), ('["X", {"clause_text": "b X"}, " ", 7, ["no"], {"text": ""}]', "X|b X"), ('{"clauses": [], "text": "X"}', "X"), ('{"clause_text": "X"}', "X"),
    ('{"clause": "X", "size": 3}', "X"), ('{"issues": [{"issue": "X"}]}', None), ('{"clauses": {"items": ["deep X"]}}', "deep X"), ('[{"clause_text": "", "text": "X"}, {"clause_text": " ", "text": "no"}]', "X"),
    ('[1, "X"]', "X"), ('{"clauses": {"clauses": {"items": {"members": {"samples": ["five X"]}}}}}', "five X"), ('{"clauses": {"text": " "}, "items": {"clause": "own X"}, "text": "later"}', "own X"),
    ("X is no JSON", None), ('{"members": [{"clause": "X"}, {"text": "and X"}], "issue": "no"}', "X|and X"), ('{"issue": 4, "issues": ["X"], "clause": "no"}', "X"),
]
_SHAPES = "CASE doc_id % 14 " + " ".join(f"WHEN {i} THEN replace('{c}', 'X', lang || ' ' || doc_id)" for i, (_, c) in enumerate(SHAPES) if c) + " END"


@query(f"SELECT CAST(row_number() OVER (ORDER BY doc_id) AS INTEGER) AS cluster_id, c AS clauses FROM (SELECT doc_id, {_SHAPES} AS c FROM documents) WHERE c IS NOT NULL")
def block_shapes(spark, d):
    path, line = fresh(spark, "shapes"), F.lit(None).cast("string")
    for i, (shape, _) in enumerate(SHAPES):
        line = F.when(F.col("doc_id") % len(SHAPES) == i, F.replace(F.lit(shape), F.lit("X"), F.concat_ws(" ", "lang", "doc_id"))).otherwise(line)
    table(spark, d, "documents").repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").select(line.alias("value")).write.text(path)
    return readers.block_lines(spark, path).withColumn("clauses", F.array_join("clauses", "|"))


@query(f"WITH {_UNIT}, m AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents) "
       "SELECT position, CAST(doc_id AS VARCHAR) AS clause_id, round(v[1], 5) AS x FROM m JOIN u ON vec_id = position")
def index_joined_by_position(spark, d):
    index, lines = fresh(spark, "index"), fresh(spark, "metadata")
    writers.vector_index(table(spark, d, "embeddings").select(F.col("vec_id").alias("position"), "embedding"), index)
    writers.jsonl(table(spark, d, "documents").repartitionByRange(3, "doc_id").sortWithinPartitions("doc_id").select(F.col("doc_id").cast("string").alias("clause_id")), lines)
    return JN.by_position(readers.vector_index(spark, index), readers.metadata(spark, lines)).select(
        "position", "clause_id", F.round(F.col("embedding")[0].cast("double"), 5).alias("x"))


@query("SELECT conv_id, turn, role, md5(text) AS body FROM conversations")
def sentiment_folders(spark, d):
    path = fresh(spark, "sentiments")
    rows = table(spark, d, "conversations").select(
        F.col("role").alias("sentiment"), F.col("conv_id").cast("string").alias("review_id"), F.col("conv_id").alias("seq"), F.col("turn").alias("pos"),
        F.lit(None).cast("string").alias("place_name"), F.concat("conv_id", F.lit("_c"), "turn").alias("clause_id"), "text", F.col("turn").alias("sentence_no"), F.lit(0.5).alias("score"))
    writers.sentiment_files(R.nest_by_review(rows), path)
    back = spark.read.json(path)
    return back.select(F.col("sentiment").alias("role"), F.col("review_id").cast("long").alias("conv_id"), F.explode("clauses").alias("c")).select(
        "conv_id", F.col("c.sentence_no").cast("int").alias("turn"), "role", F.md5("c.clause_text").alias("body"))


@query("SELECT CAST(row_number() OVER (ORDER BY doc_id) AS BIGINT) AS seq, md5(text) AS body FROM documents WHERE regexp_matches(text, '\\S')")
def reviews_column(spark, d):
    path = fresh(spark, "column")
    rows = table(spark, d, "documents").select("doc_id", F.when(X.not_blank(F.col("text")), X.strip(F.col("text"))).otherwise(" ").alias("Reviews"), "source")
    writers.csv(rows.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id"), path)
    return readers.column_of(spark, path).select("seq", F.md5("text").alias("body"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id % 5 <> 0")
def jsonl_skips(spark, d):
    path = fresh(spark, "lines")
    whole = F.to_json(F.struct("doc_id", "lang"))
    table(spark, d, "documents").select(F.when(F.col("doc_id") % 5 == 0, F.expr("left(to_json(struct(doc_id, lang)), 12)")).otherwise(whole).alias("value")).write.text(path)
    return readers.jsonl(spark, path, "doc_id long, lang string", "skip").drop("seq")


@query("SELECT CAST(doc_id AS VARCHAR) AS review_id, coalesce(text, '') AS content FROM documents")
def csv_mapped(spark, d):
    path = fresh(spark, "mapped")
    writers.csv(table(spark, d, "documents").select("lang", "doc_id", "source", "text"), path)
    return readers.csv(spark, path, {"doc_id": "review_id", "text": "content"}).drop("seq")


@query("SELECT CAST(vec_id AS VARCHAR) AS clause_id, len(embedding) AS dim, round(embedding[1]::DOUBLE, 5) AS x FROM embeddings WHERE vec_id % 7 <> 0 AND vec_id % 11 <> 0")
def vectors_read(spark, d):
    path = fresh(spark, "vectors")
    rows = table(spark, d, "embeddings").select(
        F.col("vec_id").cast("string").alias("clause_id"), F.when(F.col("vec_id") % 7 == 0, "").otherwise("said").alias("clause_text"),
        F.when(F.col("vec_id") % 11 == 0, F.array().cast("array<float>")).otherwise(F.col("embedding")).alias("embedding"))
    writers.jsonl(rows, path)
    return readers.vectors(spark, path).select("clause_id", F.size("embedding").cast("long").alias("dim"), F.round(F.col("embedding")[0].cast("double"), 5).alias("x"))


@query("SELECT CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_name || ' ' || p_partkey END AS place FROM part WHERE p_partkey % 4 <> 0")
def first_column_places(spark, d):
    path = fresh(spark, "places")
    writers.csv(table(spark, d, "part").select(F.when(F.col("p_partkey") % 4 == 0, " ").otherwise(F.concat_ws(" ", "p_name", "p_partkey")).alias("name"), "p_size"), path)
    return readers.first_column(spark, path, header=True).drop("seq")


@query("SELECT lang, doc_id, md5(text) AS body FROM documents WHERE regexp_matches(text, '\\S')")
def json_array_files(spark, d):
    path = fresh(spark, "arrays")
    rows = table(spark, d, "documents").select(
        F.concat_ws("-", "lang", "doc_id").alias("attraction_id"), F.lit("2020").alias("date"), F.lit(1.5).alias("rating"), F.col("text").alias("review_text"))
    writers.json_arrays(rows, path, "attraction_id")
    key = F.split("attraction_id", "-")
    return readers.review_array(spark, path).select(key[0].alias("lang"), key[1].cast("long").alias("doc_id"), F.md5("review_text").alias("body"))


@query("SELECT role || ' ' || conv_id || ' ' || turn AS header, md5(regexp_replace(replace(regexp_replace(regexp_replace(text, '(^|\\n)#', '\\1*', 'g'), '\\r\\n?', chr(10), 'g'), chr(133), ' '), '^\\s+|\\s+$', '', 'g')) AS body "
       "FROM conversations WHERE regexp_matches(text, '\\S')")
def markdown_files(spark, d):
    path = fresh(spark, "markdown")
    rows = table(spark, d, "conversations").select(
        F.concat_ws(" ", "role", "conv_id", "turn").alias("place"), F.regexp_replace("text", r"(^|\n)#", "$1*").alias("text"), (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"))
    writers.markdown(writers.matched_reviews(rows), path)
    return readers.markdown_sections(spark, path).select("header", F.md5("body").alias("body"))


@query(f"""WITH {_UNIT}, s AS (SELECT a.vec_id AS question, b.vec_id, list_dot_product(a.v, b.v) AS s FROM u a, u b),
    r AS (SELECT *, row_number() OVER (PARTITION BY question ORDER BY s DESC, vec_id) AS rank FROM s)
    SELECT question, CAST(rank AS INTEGER) AS rank, vec_id, round(s, 7) AS similarity FROM r WHERE rank <= 4""")
def vector_balls(spark, d):
    path = fresh(spark, "balls")
    rows = table(spark, d, "embeddings").select(F.col("vec_id").alias("seq"), "embedding")
    write_vector_balls(rows, path, ball_bytes=1 << 16)
    found = nearest_many(spark, path, rows.withColumnRenamed("seq", "question"), 4)
    return found.select("question", "rank", F.col("seq").alias("vec_id"), F.round("similarity", 7).alias("similarity"))


@query("SELECT p_partkey AS cluster_id, CASE WHEN p_partkey % 5 = 0 THEN 'new' ELSE 'old' END AS category FROM part")
def cache_in_steps(spark, d):
    path = fresh(spark, "cache")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("cluster_id"))
    writers.append_cache(rows.withColumn("category", F.lit("old")), path, every=max(10, rows.count() // 3))
    writers.append_cache(rows.where("cluster_id % 5 = 0").withColumn("category", F.lit("new")), path)
    return writers.read_cache(spark, path)
