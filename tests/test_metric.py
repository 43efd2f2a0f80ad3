"""The metric index against products of all pairs, and linkage in rounds against the matrix."""

import logging

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausewise.operators import clusters as C
from clausewise.operators import metric as M


def clustered(n, dim, groups, spread, seed):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, dim))
    x = base[rng.integers(0, groups, n)] + spread * rng.normal(size=(n, dim))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def frame(spark, x):
    return spark.createDataFrame([(i * 3 + 1, [float(v) for v in r]) for i, r in enumerate(x)], "seq long, embedding array<double>").repartition(4)


def test_pairs_and_best_are_those_of_all_products(spark):
    x = clustered(400, 12, 9, 0.25, 1)
    x[:40] = x[0]  # a hot group of equal rows
    s, df = x @ x.T, frame(spark, x)
    want = {(3 * i + 1, 3 * j + 1): s[i, j] for i in range(400) for j in range(i + 1, 400) if s[i, j] > 0.8}
    got = {(r["a"], r["b"]): r["similarity"] for r in M.pairs_above(df, 0.8).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)
    links = M.links_above(df, 0.8)
    assert links.count() < len(want) / 3
    assert dict(C.components(df, links).collect()) == dict(C.components(df, M.pairs_above(df, 0.8)).collect())
    np.fill_diagonal(s, -9)
    got = {r["seq"]: (r["other"], r["similarity"]) for r in M.best_other(df, 0.0).collect()}
    for i in range(400):
        assert abs(got[3 * i + 1][1] - s[i].max()) < 1e-12 and s[i, (got[3 * i + 1][0] - 1) // 3] > s[i].max() - 1e-12


def test_few_chunk_pairs_of_clustered_vectors_are_compared(spark, caplog):
    x = clustered(3000, 16, 40, 0.08, 2)
    with caplog.at_level(logging.INFO, "clausewise.operators.metric"):
        n = M.pairs_above(frame(spark, x), 0.8).count()
    assert n == int(((x @ x.T) > 0.8).sum() - 3000) // 2
    compared, whole = (int(w) for w in caplog.records[-1].message.replace("metric join: ", "").replace(" chunk pairs", "").split(" of "))
    assert compared < 0.2 * whole


@pytest.mark.parametrize("rows", [0, 1, 2])
def test_few_rows(spark, rows):
    df = frame(spark, clustered(5, 4, 2, 0.1, 3)).where(F.col("seq") < 3 * rows)
    assert M.pairs_above(df, -2).count() == rows * (rows - 1) // 2
    assert M.best_other(df, -2).count() == (rows if rows > 1 else 0)
    assert C.clusters(df, 0.5).count() == rows


def test_general_vectors_have_their_best(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 6)) * rng.uniform(0.1, 3, size=(300, 1))
    s = x @ x.T
    np.fill_diagonal(s, -np.inf)
    chunks = M.pack(frame(spark, x), cells=7)
    got = {r["seq"]: r["similarity"] for r in M.best_above(chunks, chunks, 1.5).collect()}
    want = {3 * i + 1: s[i].max() for i in range(300) if s[i].max() > 1.5}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_linkage_in_rounds_is_that_of_the_matrix(spark):
    distance = 0.3
    df = frame(spark, clustered(150, 8, 10, 0.35, 6))
    dense = {tuple(r) for r in C.clusters(df, distance, most=10_000).collect()}
    assert {tuple(r) for r in C.clusters(df, distance, most=1).collect()} == dense
    assert 1 < len({c for _, c in dense}) < 150


def test_vectors_are_not_shuffled_by_pair(spark):
    """Pairs of chunks are shuffled, vectors are read from the chunk files, a few chunks of a file at a time."""
    from pathlib import Path

    import pyarrow.parquet as pq

    from clausewise.operators import metric

    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = spark.createDataFrame([(i * 3, v.tolist()) for i, v in enumerate(x)], "seq long, embedding array<double>")
    found = metric.pairs_above(df, 0.9)
    assert "vectors" not in found._jdf.queryExecution().executedPlan().toString()
    s = x @ x.T
    want = {(3 * i, 3 * j) for i, j in zip(*np.nonzero(s > 0.9), strict=True) if i < j}
    got = [(r["a"], r["b"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and want
    chunks = metric.pack(df, 26)
    files = [pq.ParquetFile(f).metadata for f in Path(chunks.place.removeprefix("file://")).glob("part-*.parquet")]
    assert sum(f.num_rows for f in files) == chunks.count > 20
    assert max(f.row_group(g).num_rows for f in files for g in range(f.num_row_groups)) <= metric.HELD


def counted(monkeypatch):
    """A list that gets an item for every table that linkage packs."""
    packed, pack = [], C.pack
    monkeypatch.setattr(C, "pack", lambda *a, **b: packed.append(1) or pack(*a, **b))
    return packed


def by_brute_force(x, distance):
    far = 1 - x @ x.T
    groups = [[i] for i in range(len(x))]
    while len(groups) > 1:
        mean = np.array([[far[np.ix_(a, b)].mean() if a is not b else np.inf for b in groups] for a in groups])
        i, j = sorted(np.unravel_index(mean.argmin(), mean.shape))
        if not mean[i, j] < distance:
            break
        groups[i] += groups.pop(j)
    return {3 * i + 1: 3 * min(g) + 1 for g in groups for i in g}


def test_many_small_rounds_are_merged_by_one_task(spark, monkeypatch):
    """One component whose linkage has many rounds; the tables are packed for those of over 60 clusters only."""
    x = clustered(110, 6, 3, 1.5, 7)
    packed = counted(monkeypatch)
    assert dict(C.clusters(frame(spark, x), 0.6, most=60).collect()) == by_brute_force(x, 0.6)
    assert 0 < len(packed) <= 5


def test_equal_vectors_are_one_cluster_before_the_rounds(spark, monkeypatch):
    x = clustered(60, 8, 6, 0.4, 8)
    x[5:50] = x[5]
    packed = counted(monkeypatch)
    assert dict(C.clusters(frame(spark, x), 0.4, most=15).collect()) == by_brute_force(x, 0.4)
    assert len(packed) <= 3


def test_nearest_rows_are_not_shuffled(spark):
    """A task returns one row for each of its own that has one above the limit; ties go to the least seq."""
    x = clustered(900, 8, 5, 0.4, 9)
    x[700:] = x[3]
    df = frame(spark, x)
    chunks = M.pack(df)
    some = M.pack(df.where("seq % 2 = 0"), pivots=chunks.pivots)
    for left, chosen in ((chunks, range(900)), (some, range(1, 900, 2))):
        found = M.best_above(left, chunks, 0.9)
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
        got = {r["seq"]: (r["other"], r["similarity"]) for r in found.collect()}
        s = (x[:, None, :] * x[None, :, :]).sum(axis=2)
        np.fill_diagonal(s, -np.inf)
        want = {3 * i + 1: (3 * int(s[i].argmax()) + 1, s[i].max()) for i in chosen if s[i].max() > 0.9}
        assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 1e-12 for k in want)
