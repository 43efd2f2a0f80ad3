"""Replies are paid for once, in steps, and come back to their rows."""

import os

import pytest

from clausewise.operators import knowledge as KB
from clausewise.operators.ledger import Ledger
from clausewise.sources import writers
from clausewise.sources.steps import in_steps


def counting(folder, reply='{"issues":[{"issue":"Dirty room","importance":8}]}', dies_at=None, fails=()):
    """A provider that leaves a file for each call; it ends the worker's task at call ``dies_at``."""

    def ask(prompt):
        import os
        import uuid

        if dies_at is not None and len(os.listdir(folder)) >= dies_at:
            raise SystemExit("the run breaks off")
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(prompt)
        if any(x in prompt for x in fails):
            raise OSError("down")
        return reply

    return ask


def test_a_prompt_is_one_call(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    rows = spark.createDataFrame([(i, f"p{i % 10}") for i in range(40)] + [(99, None)], "i int, prompt string").repartition(5)
    ledger = Ledger(spark, f"file://{tmp_path}/ledger", counting(calls, "yes"), every=3, pause=0)
    for _ in range(2):
        got = ledger.ask(rows).collect()
        assert len(got) == 41 and {r["reply"] for r in got if r["i"] != 99} == {"yes"} and [r["reply"] for r in got if r["i"] == 99] == [None]
        assert len(os.listdir(calls)) == 10
    # another model's replies are its own
    assert Ledger(spark, f"file://{tmp_path}/ledger", counting(calls, "no"), model="b", pause=0).ask(rows.where("i < 10")).where("reply = 'no'").count() == 10
    assert len(os.listdir(calls)) == 20


def test_a_broken_off_run_goes_on(spark, tmp_path):
    calls, more = tmp_path / "calls", tmp_path / "more"
    calls.mkdir()
    more.mkdir()
    rows = spark.createDataFrame([(i, f"p{i}") for i in range(12)], "i int, prompt string")
    with pytest.raises(Exception):
        Ledger(spark, f"file://{tmp_path}/ledger", counting(calls, "yes", dies_at=7), every=2, tasks=1, pause=0).ask(rows)
    done = Ledger(spark, f"file://{tmp_path}/ledger", None).rows().where("reply is not null").count()
    assert done >= 4
    got = Ledger(spark, f"file://{tmp_path}/ledger", counting(more, "yes"), every=2, pause=0).ask(rows)
    assert got.where("reply = 'yes'").count() == 12 and len(os.listdir(more)) == 12 - done


def test_blocks_without_issues_stay_and_failed_ones_are_told(spark, tmp_path):
    calls = tmp_path / "calls"
    calls.mkdir()
    blocks = spark.createDataFrame([(1, ["dirty room", "long queue", "rude staff"], 3), (2, ["nothing here"], 1), (3, ["broken lift"], 1), (4, [], 0)],
                                   "cluster_id int, clauses array<string>, size int")

    def reply(prompt):
        return "no json" if "nothing" in prompt else '{"issues":[{"issue":"Dirty room","importance":8},{"issue":" ","importance":1}]}'

    kb = KB.knowledge_base(blocks, Ledger(spark, f"file://{tmp_path}/a", reply, pause=0), size=1)
    got = {r["cluster_id"]: ([tuple(i) for i in r["issues"]], r["clause_count"]) for r in kb.collect()}
    assert got == {1: ([("Dirty room", 8)], 3), 2: ([], 1), 3: ([("Dirty room", 8)], 1)}
    with pytest.warns(UserWarning, match="1 blocks are left out"):
        kb = KB.knowledge_base(blocks, Ledger(spark, f"file://{tmp_path}/b", counting(calls, fails=["queue"]), attempts=1, pause=0), size=1)
    assert sorted(r["cluster_id"] for r in kb.collect()) == [2, 3]
    failed = Ledger(spark, f"file://{tmp_path}/b", None).rows().where("error is not null").collect()
    assert len(failed) == 1 and "down" in failed[0]["error"] and len(os.listdir(calls)) == 5
    # the next run asks for the failed prompt alone
    kb = KB.knowledge_base(blocks, Ledger(spark, f"file://{tmp_path}/b", counting(calls), pause=0), size=1)
    assert kb.count() == 3 and len(os.listdir(calls)) == 6


def test_blocks_without_clauses_cost_no_call(spark, tmp_path):
    blocks = spark.createDataFrame([(1, [], 0), (2, ["x"], 1)], "cluster_id int, clauses array<string>, size int")
    calls = tmp_path / "calls"
    calls.mkdir()
    got = KB.classify(blocks, Ledger(spark, f"file://{tmp_path}/l", counting(calls, '{"category":"overcrowding","block_name":"n"}'), pause=0)).collect()
    assert sorted(tuple(r) for r in got) == [(1, "other", "", 0), (2, "overcrowding", "n", 1)] and len(os.listdir(calls)) == 1


def test_steps_compute_their_input_once(spark, tmp_path):
    from pyspark.sql import functions as F

    made = tmp_path / "made"
    made.mkdir()

    @F.udf("long")
    def seen(i):
        import uuid

        (made / uuid.uuid4().hex).touch()
        return i

    rows = spark.range(23).repartition(4).withColumn("x", seen.asNondeterministic()("id"))
    sizes = [s.count() for s in in_steps(rows, 5)]
    assert sum(sizes) == 23 and max(sizes) <= 5 and len(os.listdir(made)) == 23
    assert [s.count() for s in in_steps(rows.limit(0), 5)] == []
    path = f"file://{tmp_path}/cache"
    writers.append_cache(spark.range(12).select(F.col("id").alias("cluster_id")), path, every=3, make=lambda s: s.withColumn("category", seen.asNondeterministic()("cluster_id")))
    assert writers.read_cache(spark, path).count() == 12 and len(os.listdir(made)) == 35
