"""The pipeline's stages and the registered corpus queries on small tables."""

from collections import Counter

import __spark_entry__
import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from clausewise.llm import queries


def test_stages(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    seen = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = corpus_pipeline.materialize(stage(spark, docs, data), name)
        assert new.columns == docs.columns and new.count() == new.select("doc_id").distinct().count()
        assert new.join(docs, "doc_id", "left_anti").count() == 0
        docs = new
        seen.append(docs.count())
    assert seen == sorted(seen, reverse=True) and seen[-1] > 0.7 * seen[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert packed.select("doc_id").distinct().count() == seen[-1]


def test_near_duplicates_keep_one(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (3, "other words are here now"), (None, "lone one with five words"), (3, "other words are here now")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r["doc_id"] or 0) for r in got.collect()) == [0, 1, 3]


def test_near_copies_are_complete(spark, data):
    from clausewise.llm.near_copies import jaccard, similar_components
    from clausewise.llm.simhash import shingle_hashes

    rng = np.random.default_rng(8)
    texts = {r["text"] or "" for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    for _ in range(40):  # chains of edits around similarity 0.8
        words = [f"w{x}" for x in rng.integers(0, 9999, rng.integers(20, 300))]
        for _ in range(6):
            texts.add(" ".join(words))
            for k in rng.integers(0, len(words), max(1, len(words) // 45)):
                words[k] = f"x{rng.integers(9999)}"
    texts = sorted(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    got = {r["row"]: r["component"] for r in similar_components(docs).collect()}
    sets = [np.unique(shingle_hashes(t, 5)) for t in texts]
    label = list(range(len(texts)))
    pairs = 0
    for i in range(len(texts)):
        for j in range(i):
            if 0.8 * len(sets[i]) <= len(sets[j]) + 1e-9 and 0.8 * len(sets[j]) <= len(sets[i]) + 1e-9 and jaccard(sets[i], sets[j]) >= 0.8:
                pairs += 1
                assert got[i] == got[j]
                x, y = label[i], label[j]
                label = [min(x, y) if k in (x, y) else k for k in label]
    assert pairs > 40 and len(set(got.values())) == len(set(label))


def test_near_copies_go_through_simhash(spark, monkeypatch):
    """Without any min-hash band the tiles of fingerprints alone still connect the copies within their radius."""
    from clausewise.llm import near_copies
    from clausewise.llm.simhash import majority, shingle_hashes

    rng = np.random.default_rng(12)
    texts = []
    for _ in range(60):
        words = [f"w{x}" for x in rng.integers(0, 9999, 400)]
        texts += [" ".join(words), " ".join(words[:200] + ["new"] + words[201:])]
    fp = [majority(shingle_hashes(t, 5)) for t in texts]
    near = [k for k in range(0, len(texts), 2) if (fp[k] ^ fp[k + 1]).bit_count() <= near_copies.RADIUS]
    docs = spark.createDataFrame(list(enumerate(texts)), "row long, text string")
    monkeypatch.setattr(near_copies, "min_hash_bands", lambda h: [])
    got = {r["row"]: r["component"] for r in near_copies.similar_components(docs).collect()}
    assert len(near) > 40 and all(got[k] == got[k + 1] == k for k in near)
    assert len({*got.values()}) == len(texts) - len(near)


def test_near_duplicates_keep_other_texts(spark):
    rows = [(None, "first of the lone texts here"), (None, "second one has quite other words"), (None, "second one has quite other words"),
            (3, "some text under a hot number"), (3, "unlike words below that same id"), (4, "unlike words below that same id"), (None, "some text under a hot number")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {(r["doc_id"], r["text"]) for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert got == {rows[0], rows[1], rows[3], rows[4]}


def test_stage_drops_near_copies(spark):
    words = [f"w{i}" for i in range(200)]
    edited = words[:50] + ["new"] + words[51:120] + ["other"] + words[121:]
    rows = [(1, " ".join(words)), (2, " ".join(edited)), (3, " ".join(words[:100] + ["y"] * 100))]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == [1, 3]


CLASHES = ("__id", "__row", "__spans", "__new", "__found", "__toxic", "__score", "toxic", "Toxicity", "lines_deleted", "runs_deleted", "words_left",
           "row", "found", "component", "a.dotted `name`", "bands", "n")


def odd_docs(spark):
    """Nulls, empty and very long texts, ties and repeated rows, and columns of names that the
    operators use themselves."""
    rng = np.random.default_rng(17)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n)) + "."
    long = " ".join(say(15) for _ in range(3000))
    passage = say(70)
    rows = [(1, "plain words that nobody repeats"), (2, None), (3, ""), (None, "without a number"), (None, "another one without a number"), (5, long),
            (6, "plain words that nobody repeats"), (7, "token=abcdefgh123 stands here"), (7, "token=abcdefgh123 stands here"),
            (8, say(20) + "\n" + passage), (9, say(20) + "\n" + passage), (None, None), (10, "日本 語"), (11, "\n\n ")]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c.replace('`', '``')}` string" for c in CLASHES)
    return spark.createDataFrame([(i, t, "en", None, 1, *[f"{i} {c}" for c in CLASHES]) for i, t in rows], kinds), rows, passage


@pytest.mark.parametrize("k", range(4))
def test_stage_keeps_columns_and_odd_rows(spark, data, k):
    docs, rows, passage = odd_docs(spark)
    name, stage = corpus_pipeline.STAGES[k]
    done = stage(spark, docs, data)
    assert done.columns == docs.columns
    got = done.collect()
    assert all(r[c] == f"{r['doc_id']} {c}" for r in got for c in CLASHES)  # their values are those of the row
    left = Counter((r["doc_id"], r["text"]) for r in got)
    want = Counter(rows)
    if name == "line_dedup":
        want[9, rows[10][1]] -= 1
        want[9, rows[10][1][: -len(passage)]] += 1
    elif name == "simhash":  # copies, rows that repeat, and all the texts without words but one
        want = Counter(set(rows)) - Counter([rows[6], rows[2], rows[11], rows[13]])
    elif name == "secrets":
        want[rows[7]] = 0
        want[7, "[secret] stands here"] = 2
    assert left == +want
    assert stage(spark, docs.limit(0), data).count() == 0


def test_last_stage_packs_odd_rows(spark, data):
    docs, rows, _ = odd_docs(spark)
    got = corpus_pipeline.STAGES[-1][1](spark, docs, data).collect()
    assert Counter(r["doc_id"] for r in got if r["start"] == 0) == Counter(i for i, _ in rows)
    assert sum(r["length"] for r in got) == sum(r["doc_tokens"] for r in got if r["start"] == 0)
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), data).count() == 0


def test_toxicity_does_not_depend_on_partitions(spark, data):
    from clausewise.llm.toxicity import score, train

    docs, labels = (spark.read.parquet(f"{data}/{t}.parquet") for t in ("documents", "labels"))
    a, b = ({r["doc_id"]: r["toxicity"] for r in score(docs.repartition(n), train(docs.repartition(n), labels.repartition(n))).collect()} for n in (1, 7))
    assert a == b


def test_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in __spark_entry__.queries()


def test_top_k_sql(spark, data):
    import duckdb

    c = duckdb.connect()
    c.sql(f"create view embeddings as from '{data}/embeddings.parquet'")
    want = c.sql(queries.ORACLE_SQL["op7_top_k"] + " ORDER BY 1, 2").fetchall()
    got = queries.QUERIES["op7_top_k"](spark, data).orderBy("query_id", "rank")
    assert [tuple(r) for r in got.collect()] == want


def test_lexical_sql(spark, data):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark"):
        c.sql(f"create view {t} as from '{data}/{t}.parquet'")
    want = c.sql(f"SELECT item_id, rank, doc_id, score FROM ({queries.ORACLE_SQL['op11_lexical']}) ORDER BY 1, 2").fetchall()
    got = queries.QUERIES["op11_lexical"](spark, data).orderBy("item_id", "rank")
    assert [tuple(r) for r in got.collect()] == want


@pytest.mark.parametrize("name", ["op12_align", "op2_toxicity", "op3_html_text", "op10_secrets"])
def test_rows_are_whole(spark, data, name):
    table = "pages" if name.startswith("op3") else "documents"
    assert queries.QUERIES[name](spark, data).select(F.count("*")).first()[0] == spark.read.parquet(f"{data}/{table}.parquet").count()
