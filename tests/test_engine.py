"""Registered queries against DuckDB, and the operators SQL does not express against brute force."""

import io
import json
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clausewise import cli
from clausewise.operators import clusters as C
from clausewise.operators import joins as JN
from clausewise.operators import knowledge as KB
from clausewise.operators import taxonomy as T
from clausewise.operators.ledger import Ledger
from clausewise.operators.providers import HashEmbedding, LexiconSentiment, call
from clausewise.plans import pipeline
from clausewise.plans import queries as P
from clausewise.sources import readers, writers


@pytest.fixture(scope="module")
def duck(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.sql(f"create view {f[:-8]} as from '{data}/{f}'")
    return c


def key(row):
    return tuple("" if x is None else repr(float(x)) if isinstance(x, (int, float)) else str(x) for x in row)


@pytest.mark.parametrize("name", sorted(P.ORACLE_SQL))
def test_query(spark, data, duck, name):
    df = P.QUERIES[name](spark, data)
    rel = duck.sql(P.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    at = [rel.columns.index(c) for c in df.columns]
    assert sorted(key(tuple(r)) for r in df.collect()) == sorted(key(tuple(r[i] for i in at)) for r in rel.fetchall())


def test_average_linkage_by_components(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 8))
    x = np.repeat(base, 6, axis=0) + 0.35 * rng.normal(size=(72, 8))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "seq long, embedding array<double>")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    far = 1 - unit @ unit.T
    for t in (0.1, 0.2, 0.45):
        groups = [[i] for i in range(len(x))]
        while len(groups) > 1:
            best = min((far[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j)
            if best[0] >= t:
                break
            groups[best[1]] += groups.pop(best[2])
        got = {}
        for r in C.clusters(df, t).collect():
            got.setdefault(r["cluster"], set()).add(r["seq"])
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups))


def test_blocks_number_by_size(spark):
    rows = [(i, i % 2 if i < 7 else 5, f"t{i}", None if i == 3 else "p") for i in range(9)]
    got = C.blocks(spark.createDataFrame(rows, "seq long, cluster long, text string, place string")).collect()
    assert [(r["cluster_id"], r["size"], r["place_names"]) for r in got] == [(1, 4, ["p"]), (2, 3, ["", "p"])]


def test_join_missing_keys(spark):
    a = spark.createDataFrame([(None, 1), ("", 2), ("k", 3)], "k string, x int")
    b = spark.createDataFrame([(None, 10), ("", 20), ("k", 30), ("k", 31)], "k string, y int")
    assert sorted(tuple(r) for r in JN.join_reviews(a, b, "k", ["x"]).collect()) == [(1, 10), (2, 20), (3, 30), (3, 31)]
    assert JN.join_reviews(a, b, "k", ["x"], null_keys_match=False).count() == 3
    assert JN.join_reviews(a, b, "k").columns == ["y"]


def test_pipeline_and_knowledge_base(spark, tmp_path):
    (tmp_path / "r.csv").write_text('﻿review_id,content,translated_content,google_place_id\n1,"dirty beach, but ""nice"" view of the sea",,p\n'
                                    '2,x,"The room was terrible and dirty. The room was terrible and dirty.",p\n3,,,p\n', encoding="utf-8")
    (tmp_path / "p.csv").write_text("google_place_id,place_name\np,Beach\n")
    reviews, places = readers.csv(spark, f"file://{tmp_path}/r.csv"), readers.csv(spark, f"file://{tmp_path}/p.csv")
    times = {}
    out = pipeline.run(spark, reviews, places, LexiconSentiment(), HashEmbedding(16), folder=f"file://{tmp_path}/out", times=times)
    rows = out.collect()
    assert [r["clause_text"] for r in rows] == ["The room was terrible and dirty."] and len(rows[0]["embedding"]) == 16 and set(times) == set(pipeline.STAGES)
    again = pipeline.run(spark, reviews, places, LexiconSentiment(), HashEmbedding(16), folder=f"file://{tmp_path}/out", start=6)
    assert again.count() == 1
    blocks = spark.createDataFrame([(1, ["dirty room", "dirty room", "long queue"], 3)], "cluster_id int, clauses array<string>, size int")
    books = iter(range(99))
    ledger = lambda provider: Ledger(spark, f"file://{tmp_path}/ledger{next(books)}", provider, pause=0)
    kb = KB.knowledge_base(blocks, ledger(lambda p: '{"issues":[{"issue":"Dirty room","importance":8},{"issue":"Queue","importance":2}]}')).first()
    assert kb["clause_count"] == 2 and [i[0] for i in kb["issues"]] == ["Dirty room", "Queue"]
    cat = KB.classify(blocks, ledger(lambda p: '{"category":"Overcrowding","block_name":"b"}')).first()
    assert (cat["category"], cat["block_name"]) == ("overcrowding", "b")
    assert KB.classify(blocks, ledger(lambda p: "junk"), fine=True).first()["subcategory_key"] == "other"
    writers.append_cache(blocks.select("cluster_id"), f"file://{tmp_path}/cache")
    assert KB.classify(blocks, ledger(lambda p: ""), cache=writers.read_cache(spark, f"file://{tmp_path}/cache")).count() == 0
    judged = KB.judge(spark.createDataFrame([(1, "bad", "Here")], "seq int, text string, location string"),
                      ledger(lambda p: '[{"index":1,"reason":"r","action_items":["a","b"]},{"index":9,"reason":"q","action_items":[]}]'))
    assert sorted(tuple(r) for r in judged.collect()) == [("Here", "r", "a; b"), ("Review 9", "q", "")]
    engine = KB.Engine(again, HashEmbedding(16), lambda p: '{"summary":"s","actions":["a"]}')
    answer = engine.ask("terrible room")
    assert answer["summary"] == "s" and answer["source_clauses"][0]["place_name"] == "Beach" and engine.ask(" ")["source_clauses"] == []


def test_calls_are_tried_again():
    seen = []

    def fails(prompt):
        seen.append(prompt)
        raise OSError("down")

    with pytest.raises(OSError):
        call(fails, "p", attempts=3, pause=0)
    assert len(seen) == 3
    assert KB.consolidate([{"issue": "a", "importance": 1}], fails) == [{"issue": "a", "importance": 1}]


def test_search_routes_or_falls_back(spark):
    reviews = spark.createDataFrame([(1, 1, "spice beach nungwi sunset", 2.0, "2020"), (2, 2, "other words here", float("nan"), "2021")],
                                    "review_id long, seq long, text string, rating double, date string")
    places = spark.createDataFrame([(1, "Nungwi Beach"), (2, "Paje Spot")], "seq long, place string")
    found, place = JN.search_reviews("nungwi", reviews, places)
    assert place == "Nungwi Beach" and [r["review_id"] for r in found.collect()] == [1]
    found, place = JN.search_reviews("other words", reviews, places)
    assert place is None and [r["review_id"] for r in found.collect()] == [2]


def test_readers(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"cluster_id":1,"clauses":["a"],"size":1}\n\nnot json\n')
    assert readers.jsonl(spark, f"file://{tmp_path}/b.jsonl", readers.BLOCK, "skip").where("cluster_id is not null").count() == 1
    lines = ['"one"', '["a", {"clause_text":"b"}, " "]', '{"items":[{"text":"c"}]}', '{"text":"d"}', "junk"]
    got = spark.createDataFrame([(x,) for x in lines], "l string").select(readers.block_texts(F.col("l")).alias("t")).collect()
    assert [r["t"] for r in got] == [["one"], ["a", "b"], ["c"], ["d"], []]
    with pytest.raises(ValueError):
        (tmp_path / "c.csv").write_text("a,b\n1,2\n")
        readers.csv(spark, f"file://{tmp_path}/c.csv", {"z": "z"})


def test_taxonomies():
    assert len(T.fine_rows()) == 75 and len({r[3] for r in T.fine_rows()}) == 75 and len(T.COARSE) == 21


def test_missing_metadata_is_empty_and_warned_of(spark, tmp_path):
    with pytest.warns(UserWarning, match="no metadata"):
        assert readers.metadata(spark, str(tmp_path / "none")).count() == 0


def test_skipped_lines_are_counted(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"x": 1}\n{bad\n{"x": 2}\n')
    assert readers.skipped_lines(spark, str(tmp_path / "a.jsonl"), "x int") == 1
    assert readers.jsonl(spark, str(tmp_path / "a.jsonl"), "x int", "skip").count() == 2


def test_markdown_and_progress(spark, tmp_path):
    rows = spark.createDataFrame([(2, "Farm", "late", "a; b"), (1, "Beach", "dirty", ""), (3, "Farm", "ok", "")], "seq long, location_name string, judgement string, action string")
    writers.markdown(writers.judged_reviews(rows), str(tmp_path / "md"))
    text = "\n".join(r["value"] for r in spark.read.text(str(tmp_path / "md")).collect())
    assert text.index("## Beach") < text.index("late\n\n**Actions:** a; b") and text.count("## Farm") == 2
    assert [r["text"] for r in writers.numbered_reviews(rows.withColumn("text", F.col("judgement"))).orderBy("order").collect()][0] == "## Review 1\n\ndirty\n"
    assert writers.matched_reviews(rows.select("seq", F.col("location_name").alias("place"), F.col("judgement").alias("text"))).count() == 3
    writers.progress(str(tmp_path / "p.json"), 3, 9, stage="judge")
    assert json.loads((tmp_path / "p.json").read_text()) == {"done": 3, "total": 9, "stage": "judge"}
    writers.csv(rows, str(tmp_path / "csv"), single=True)
    assert b"\r\n" in next((tmp_path / "csv").glob("*.csv")).read_bytes()


def test_strict_judgements(spark):
    from clausewise.functions.replies import parse_judgements

    rows = spark.createDataFrame([("```json\n[{\"index\": 1}]\n```",), ("no list",)], "raw string")
    assert rows.where("raw <> 'no list'").select(parse_judgements(F.col("raw"), strict=True)[0]["index"]).first()[0] == 1
    assert rows.where("raw = 'no list'").select(parse_judgements(F.col("raw"))).first()[0] is None
    with pytest.raises(Exception, match="not a JSON list"):
        rows.select(parse_judgements(F.col("raw"), strict=True)).collect()


def test_escape_without_quotes(spark):
    from clausewise.functions.text import html_escape

    assert spark.range(1).select(html_escape(F.lit("<a href='x'>&"), quotes=False)).first()[0] == "&lt;a href='x'&gt;&amp;"


def test_answer_prompt_holds_titles_and_letters():
    prompt = KB.answer_prompt("why?", [{"clause_text": "x" * 900, "place_name": "Beach", "score": 0.5}, {"text": "late", "rating": float(2), "place": None}])
    assert "Overcrowding" in prompt and "[1] place: Beach | score: 0.50" in prompt and "x" * 400 in prompt and "x" * 401 not in prompt and "score: 2.00" in prompt


def test_layout_keeps_neighbours(spark, data):
    from clausewise.operators import html_report as H

    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 20))
    x = base[rng.integers(0, 12, 240)] + 0.3 * rng.normal(size=(240, 20))
    df = spark.createDataFrame([(i, [float(v) for v in r], 0, f"t<{i}>") for i, r in enumerate(x)], "seq long, embedding array<double>, cluster int, text string")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    order = np.argsort(np.argsort(1 - unit @ unit.T + 9 * -np.eye(240), axis=1), axis=1)

    def trust(rows, k=15):
        at = np.array([[r["x"], r["y"]] for r in sorted(rows, key=lambda r: r["seq"])])
        far = ((at[:, None] - at[None]) ** 2).sum(axis=2)
        near = np.argsort(far, axis=1)[:, 1 : k + 1]
        return 1 - 2 / (240 * k * (2 * 240 - 3 * k - 1)) * sum(max(0, order[i, j] - k) for i in range(240) for j in near[i])

    made = H.neighbour_layout(df, epochs=8)
    rows = made.collect()
    assert len(rows) == 240 and trust(rows) > trust(H.project_2d(df).collect()) + 0.02
    page = H.scatter_page(spark.createDataFrame(rows), each=100)
    assert page.count("<circle") == 100 and "t&lt;" in page


def test_commands(spark, tmp_path):
    texts = [f"dirty beach and water number {i}" if i % 2 else f"slow staff at the counter {i}" for i in range(20)]
    embed = HashEmbedding()
    rows = [(i, t, "Beach" if i % 2 else "Farm", 0.9, v) for i, (t, v) in enumerate(zip(texts, embed.encode(texts)))]
    spark.createDataFrame(rows, "seq long, clause_text string, place_name string, score double, embedding array<float>").write.parquet(str(tmp_path / "clauses"))
    reply = '{"summary": "Clean it.", "actions": ["sweep"]}'

    def run(*args, lines=()):
        out = io.StringIO()
        return cli.main(["--folder", str(tmp_path), *args], spark, lambda prompt: reply, embed, out, lines), out.getvalue()

    code, said = run("ask", "--clauses", "clauses", "--max-clauses", "4", "--json", "beach?")
    assert code == 0 and json.loads(said)["summary"] == "Clean it." and len(json.loads(said)["source_clauses"]) == 4
    code, said = run("ask", "--clauses", "clauses", "--interactive", lines=["why dirty?\n", "quit\n", "never\n"])
    assert code == 0 and said.count("Clean it.") == 1 and "- sweep" in said
    assert run("ask", "--clauses", "clauses")[0] == 2
    assert run("cluster", "--clauses", "clauses", "--out", "blocks", "--dry")[1] == "2 blocks\n"
    assert run("cluster", "--clauses", "clauses", "--out", "blocks")[0] == 0 and spark.read.parquet(str(tmp_path / "blocks")).count() == 2
    spark.read.parquet(str(tmp_path / "clauses")).withColumn("cluster", F.col("seq") % 2).write.parquet(str(tmp_path / "clusters"))
    assert json.loads(run("report", "--clusters", "clusters")[1])["blocks"] == 2
    (tmp_path / "r.csv").write_text('review_id,content,translated_content,google_place_id\n1,"The room was terrible and dirty. Rude staff at the gate.",,p\n')
    (tmp_path / "p.csv").write_text("google_place_id,place_name\np,Beach\n")
    out = io.StringIO()
    assert cli.main(["--folder", str(tmp_path), "pipeline", "--reviews", "r.csv", "--places", "p.csv", "--out", "stages"], spark, None, embed, out, (), LexiconSentiment()) == 0
    assert out.getvalue().count("s\n") == 6 and spark.read.parquet(str(tmp_path / "stages" / "embed")).count() == 2
    (tmp_path / "b.jsonl").write_text('["dirty room", "queue"]\n{"clauses": []}\n{"text": "rude staff"}\n')
    reply = '{"issues": [{"issue": "Dirt", "importance": 7}]}'
    assert run("kb", "--blocks", "b.jsonl", "--ledger", "ledger", "--out", "kb") == (0, "2 entries\n")
    reply = '{"category": "Overcrowding", "block_name": "b"}'
    for cached in range(2):
        assert run("classify", "--blocks", "blocks", "--ledger", "ledger", "--cache", "cache", "--out", "groups")[0] == 0
        groups = spark.read.json(str(tmp_path / "groups")).collect()
        assert [(g["category"], g["block_count"]) for g in groups] == [("overcrowding", 2)]
    assert run("classify", "--blocks", "blocks", "--ledger", "ledger", "--cache", "cache", "--out", "groups", "--report-only")[0] == 0
    assert run("visualise", "--clusters", "clusters", "--out", "page.html", "--report-only")[0] == 0 and not (tmp_path / "page.html").exists()
    with pytest.raises(SystemExit, match="names the embedding provider"):
        cli.main(["--folder", str(tmp_path), "ask", "--clauses", "clauses", "q"], spark, lambda prompt: reply)
    assert cli.named("clausewise.operators.providers:HashEmbedding", "embedding").dim == 64
    with pytest.raises(ValueError, match="dimensions"):
        cli.main(["--folder", str(tmp_path), "ask", "--clauses", "clauses", "q"], spark, lambda prompt: reply, HashEmbedding(16))
    assert readers.resolve("/a/b", "/f") == "/a/b" and readers.resolve("b", "/f") == "/f/b" and readers.resolve("s3://x/b", "/f") == "s3://x/b"
