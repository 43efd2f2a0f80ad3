"""Readers that split files, counters of the same pass, and the vector index."""

import json
import logging

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from clausewise.operators import clusters as C
from clausewise.operators.providers import HashEmbedding, LexiconSentiment
from clausewise.operators.reviews import sections
from clausewise.operators.vector_index import nearest_many, write_vector_balls
from clausewise.plans import pipeline
from clausewise.sources import readers
from clausewise.sources.json_arrays import read_json_array

SCHEMA = "attraction_id string, date string, rating double, review_text string"


def rows_of(rng, n):
    odd = ['plain', 'a "quoted, text" [x]', "back\\slash", 'ends in \\', '"', "[{", "}],", "new\nline", "日本 😀", "", " , ", '\\"', "\\\\"]
    return [{"attraction_id": str(i), "date": f"20{rng.integers(10, 25)}", "rating": float(rng.integers(1, 6)), "review_text": "".join(rng.choice(odd, rng.integers(0, 6))),
             "more": {"deep": [1, [2, {"x": "]"}]]}} for i in range(n)]


@pytest.mark.parametrize("split", [7, 61, 400, 1 << 20])
def test_arrays_do_not_depend_on_splits(spark, tmp_path, split):
    rng = np.random.default_rng(3)
    first, second = rows_of(rng, 25), rows_of(rng, 14)
    (tmp_path / "a.json").write_text(json.dumps(first, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "b.json").write_text("﻿ " + json.dumps(second, indent=2) + "\n", encoding="utf-8")
    (tmp_path / "c.json").write_text(" [ ] ")
    (tmp_path / "d.json").write_text("")
    got = read_json_array(spark, str(tmp_path), SCHEMA, split).orderBy("seq").collect()
    assert [(r["attraction_id"], r["date"], r["rating"], r["review_text"]) for r in got] == [tuple(list(x.values())[:4]) for x in [*first, *second]]


def test_reviews_without_text_are_left_out(spark, tmp_path):
    (tmp_path / "r.json").write_text('[{"review_text": "x", "rating": NaN}, {"review_text": "  "}, {"rating": 2}]')
    got = readers.review_array(spark, str(tmp_path / "r.json")).collect()
    assert [r["review_text"] for r in got] == ["x"] and got[0]["rating"] != got[0]["rating"]


def test_sections_do_not_depend_on_splits(spark, tmp_path):
    text = "# Title\nintro\n" + "".join(f"## Place {i}\n\n" + "".join(f"line {k} of {i}\n" for k in range(i % 5)) + "# note\n" for i in range(60))
    (tmp_path / "a.md").write_text(text)
    (tmp_path / "b.md").write_text("## Only\n\nbody")
    whole = sections(readers.markdown(spark, str(tmp_path)))
    want = sorted((r["section"], r["header"], r["body"]) for r in whole.collect())
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "200b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1b")
            got = readers.markdown_sections(spark, str(tmp_path))
            assert sorted((r["section"], r["header"], r["body"]) for r in got.collect()) == want and len(want) == 49
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_counts_come_from_the_same_pass(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n{bad\n{"x": 2}\n\n{"x": 3}\n')
    counts = Observation("lines")
    assert sorted(r["x"] for r in readers.jsonl_counted(spark, str(tmp_path / "a.jsonl"), "x int", counts).collect()) == [1, 2, 3]
    assert counts.get == {"lines": 4, "skipped": 1}
    reviews = spark.createDataFrame(
        [(1, "a", "dirty beach. Long queue here.", "", "p"), (2, "b", "x", " rude and terrible staff ", "p"), (3, "c", "  ", None, "p"), (4, "d", "lost", None, "none")],
        "seq long, review_id string, content string, translated_content string, google_place_id string")
    places = spark.createDataFrame([("p", "Beach")], "google_place_id string, place_name string").withColumn("seq", F.lit(1))
    counts = {}
    out = pipeline.run(spark, reviews, places, LexiconSentiment(), HashEmbedding(8), counts=counts)
    out.write.format("noop").mode("overwrite").save()  # one action
    told = {k: o.get for k, o in counts.items()}
    assert told["join"] == {"rows": 3} and told["swap"] == {"rows": 3, "swapped": 1} and told["read"] == {"rows": 3}
    assert told["split"] == {"written": 2, "clauses": 3} and told["classify"] == {"rows": 3}


def test_vector_index_is_exact_and_skips(spark, tmp_path, caplog):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(20, 16))
    x = base[rng.integers(0, 20, 2000)] + 0.1 * rng.normal(size=(2000, 16))
    x[7] = x[3]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(5000, [0.0] * 16)], "seq long, embedding array<double>")
    path = str(tmp_path / "index")
    write_vector_balls(df, path, ball_bytes=16 * 8 * 100)
    some = [3, 700, 1500]
    questions = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in some], "question long, embedding array<double>")
    with caplog.at_level(logging.INFO, "clausewise.operators.vector_index"):
        got = nearest_many(spark, path, questions, 5).orderBy("question", "rank").collect()
    unit = C.unit_vectors(df)
    for i in some:
        q = unit.where(F.col("seq") == i).first()["embedding"]
        want = C.nearest(unit, q, 5).collect()
        mine = [r for r in got if r["question"] == i]
        assert [r["seq"] for r in mine] == [r["seq"] for r in want]
        assert np.allclose([r["similarity"] for r in mine], [r["similarity"] for r in want], atol=1e-12)
    opened, balls = (int(w) for w in caplog.records[-1].message.replace("vector index: ", "").replace(" balls opened", "").split(" of "))
    assert opened < balls / 2
    assert nearest_many(spark, path, questions.where("question < 0"), 5).count() == 0


def test_array_files_hold_no_language_in_a_group(spark, data, tmp_path, monkeypatch):
    """Arrays are written row by row: each file is one array, and no row of the plan holds a language."""
    import json

    from clausewise.plans import queries
    from clausewise.sources import writers

    rows = spark.range(500).selectExpr("cast(id as string) id", "repeat('a\"[,]', cast(id % 9 as int)) text").repartition(7)
    writers.json_arrays(rows, f"file://{tmp_path}/a", "id")
    parts = [json.loads(p.read_text()) for p in sorted((tmp_path / "a").glob("part-*")) if p.stat().st_size]
    assert [x for p in parts for x in p] == [r.asDict() for r in rows.orderBy("id").collect()]
    writers.json_arrays(rows.limit(0), f"file://{tmp_path}/b", "id")
    assert read_json_array(spark, f"file://{tmp_path}/b", "id string").count() == 0

    monkeypatch.setattr(queries, "fresh", lambda *_: f"file://{tmp_path}/c")
    queries.json_array_files(spark, data).count()
    longest = max(len(line) for p in (tmp_path / "c").rglob("part-*") for line in p.read_text().split("\n"))
    texts = spark.read.parquet(f"{data}/documents.parquet").selectExpr("max(length(to_json(struct(text)))) most", "sum(length(text)) total").first()
    assert longest < texts["most"] + 200 < texts["total"]
