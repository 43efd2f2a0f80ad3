"""Ordered merging, the review index, the keyword automaton and streams, each against its plain form."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausewise.functions.arrays import merge_near_duplicates
from clausewise.operators import joins as JN
from clausewise.operators import reviews as R
from clausewise.operators.keywords import first_of_keywords
from clausewise.operators.ordered_merge import merge_lists
from clausewise.operators.review_index import search_many, write_review_index
from clausewise.streaming import stateless as S


def texts(rng, n, words, most):
    vocabulary = [f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}x" for i in range(words)]
    p = 1 / np.arange(1, words + 1)
    return [" ".join(rng.choice(vocabulary, rng.integers(0, most), p=p / p.sum())) for _ in range(n)]


@pytest.mark.parametrize("threshold", [0.3, 0.45, 0.8, 1.0])
def test_merged_lists_are_those_of_the_fold(spark, threshold):
    rng = np.random.default_rng(int(threshold * 100))
    lists = [(i, texts(rng, n, 12, 6) + ["", "...", "日本", "the of", None]) for i, n in enumerate([0, 1, 40, 90])]
    lists.append((9, texts(rng, 60, 300, 14) * 2))
    df = spark.createDataFrame(lists, "k long, t array<string>")
    want = dict(df.select("k", merge_near_duplicates(F.col("t"), threshold).alias("t")).collect())
    assert dict(merge_lists(df, "k", "t", threshold, fold_most=0).collect()) == want
    assert dict(merge_lists(df, "k", "t", threshold, fold_most=50).collect()) == want


def test_questions_together_are_questions_one_by_one(spark, tmp_path):
    rng = np.random.default_rng(8)
    vocabulary = "nungwi spice jozani stone kendwa paje dirty queue rude staff sunset tour reef boat".split()
    reviews = spark.createDataFrame(
        [(i, i, " ".join(rng.choice(vocabulary, 4)), None if i % 7 == 0 else float("nan") if i % 5 == 0 else float(rng.integers(1, 6)), f"20{rng.integers(10, 25)}") for i in range(120)],
        "review_id long, seq long, text string, rating double, date string")
    places = spark.createDataFrame([(1, "Nungwi Reef"), (2, "Jozani Forest Tour"), (3, "reef NUNGWI"), (4, "Nowhere Lagoon"), (5, "Spice Farm"), (6, "the old")], "seq long, place string")
    asked = ["nungwi", "is jozani tour dirty", "rude staff", "lagoon", "the of a", "", "zzz unknown", "spice farms of kendwa and paje or stone town with boats", "reef nungwi jozani"]
    path = str(tmp_path / "index")
    write_review_index(reviews, places, path)
    got = {}
    for r in search_many(spark, path, spark.createDataFrame(list(enumerate(asked)), "question int, text string"), 6).orderBy("question", "rank").collect():
        got.setdefault(r["question"], (r["place"], []))[1].append(r["review_id"])
    for i, q in enumerate(asked):
        found, place = JN.search_reviews(q, reviews, JN.distinct_places(places), 6)
        want = [r["review_id"] for r in found.collect()]
        assert got.get(i, (None, [])) == (place if want else None, want), q


def test_first_keyword_is_brute_force(spark):
    rng = np.random.default_rng(10)
    words = ["".join(rng.choice(list("abcdeÄ "), rng.integers(1, 5))) for _ in range(400)]
    rows = [(i, "".join(rng.choice(list("abcdeäABC xyz"), rng.integers(0, 30)))) for i in range(200)] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "i int, text string")
    for keys in (words, words[:3], [], ["zz", ""], ["A", "a"]):
        table = spark.createDataFrame(list(enumerate(keys)), "seq int, keyword string")
        want = {i: None if t is None else next((k for k in keys if k.lower() in t.lower()), None) for i, t in rows}
        for part in (200_000, 90):
            assert dict(first_of_keywords(df, table, part=part).select("i", "keyword").collect()) == want


REVIEWS = [
    [(3, "c", "P", "The room was dirty, but the staff were kind."), (1, "a", "P", "Long queue at the gate.")],
    [(2, "b", None, "The room was dirty."), (0, "z", "Q", "Long queue at the gate. Nice view of the sea.")],
    [(4, "d", "Q", "  "), (5, "e", "Q", "The room was dirty, although it rained a lot.")],
]


def test_a_finished_stream_is_the_batch(spark, tmp_path):
    for k, rows in enumerate(REVIEWS):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(("seq", "review_id", "place_name", "content"), r))) for r in rows))
    schema = "seq long, review_id string, place_name string, content string"
    batch = spark.read.schema(schema).json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))

    def ended(df, mode, name):
        query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination(300)
        assert not query.isActive
        return spark.table(name)

    want = R.flatten(R.clause_reviews(batch))
    got = ended(S.clause_stream(stream), "append", "clauses_of_stream")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and want.count() == 6
    first = ended(S.first_clauses(S.clause_stream(stream)), "complete", "first_of_stream")
    assert sorted(map(str, first.select(want.columns).collect())) == sorted(map(str, R.first_occurrences(want).select(want.columns).collect())) and first.count() < 6


def test_spreading_runs_no_job(spark, data):
    tracker, rows = spark.sparkContext.statusTracker(), spark.read.parquet(f"{data}/documents.parquet").groupBy("lang").count()
    spark.sparkContext.setJobGroup("spread", "")
    R.spread(rows)
    assert not tracker.getJobIdsForGroup("spread")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_long_lists_are_not_broadcast(spark):
    """Exploded tokens are far larger than the file that they come from tells."""
    from clausewise.operators.ordered_merge import similar_before

    rng = np.random.default_rng(3)
    sets = [sorted({f"w{x}" for x in rng.integers(0, 60, rng.integers(1, 40))}) for _ in range(300)]
    for k in range(0, 300, 10):
        sets[k] = sorted({*sets[k - 1][: len(sets[k - 1]) * 3 // 4], f"x{k}"})
    df = spark.createDataFrame([("a", i, t) for i, t in enumerate(sets)], "list string, pos long, tokens array<string>")
    found = similar_before(df, 0.45)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    want = {(i, j) for j in range(300) for i in range(j) if len({*sets[i]} & {*sets[j]}) / len({*sets[i]} | {*sets[j]}) >= 0.45}
    assert {(r["a"], r["b"]) for r in found.collect()} == want and len(want) > 30
