"""Operator 7: exact top-k by inner product, ball trees with branch and bound on each shard.

Vectors become integers (floor(scale * x)), so scores are exact.  Rows are dealt to shards by place, not at
random: pivots spread over a bounded sample make cells, rows are range-sorted by cell and distance from the
pivot, and a shard is a run of at most ``shard_rows`` of them, so it is a small ball.  Its ball tree is built
once and kept as a row.  Queries are packed the same way.  In a tree, nodes are visited in the order of the
upper bound q.c + |q| r, and queries whose bound is below their current k-th score drop out of the node.
The search goes in waves: every block of queries meets its best shard, then the few next ones, then the rest;
the k-th scores over all earlier waves go along with the queries, and a shard whose ball cannot hold
anything as good as the worst of a block's k-th scores is left out.
"""

from __future__ import annotations

import logging
import pickle

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clausewise.operators.metric import MOST_CELLS, spread_pivots

from .common import lean, materialize, small_batches

log = logging.getLogger(__name__)
SAFE = float(1 << 53)
LOW = -(2**63) + 1  # below every score; its negative is a long too
#: blocks and shards: the vectors of ``rows`` rows in place order, a tree (shards) or the plain arrays
PACKED = "part long, dim int, n int, ids array<long>, keys array<long>, tree binary, centre array<double>, radius double, top double"


def quantized(vectors: DataFrame, scale: float = 256.0) -> DataFrame:
    """vec_id, q (array of long), dim, for rows whose vector and components are finite and not
    null.  Components are floored as doubles times ``scale``."""
    e = F.col("embedding")
    fine = e.isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    q = F.transform(e, lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    return vectors.where(fine).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"), F.size("embedding").alias("dim"))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer a @ b.T; as doubles where every sum stays below 2^53, else as whole numbers."""
    top = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if top < SAFE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if top < 2.0**62:
        return a @ b.T
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, LOW + 1, 2**63 - 1).astype(np.int64)


class BallTree:
    """Nodes over rows that are ordered so that a node is a range of rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 256):
        order = np.arange(len(ids))
        self.nodes: list[tuple[int, int, int, int]] = []  # begin, end, children (or -1)
        centres, radii, least = [], [], []
        as_float = vectors.astype(np.float64)

        def build(begin: int, end: int) -> int:
            at = len(self.nodes)
            self.nodes.append((begin, end, -1, -1))
            own = as_float[order[begin:end]]
            centre = own.mean(axis=0)
            apart = np.sqrt(((own - centre) ** 2).sum(axis=1))
            centres.append(centre)
            radii.append(float(apart.max()))
            least.append(int(ids[order[begin:end]].min()))
            if end - begin > leaf and radii[at] > 0:
                a = own[int(apart.argmax())]
                b = own[int((((own - a) ** 2).sum(axis=1)).argmax())]
                side = own @ (b - a)
                half = (end - begin) // 2
                order[begin:end] = order[begin:end][np.argsort(side, kind="stable")]
                self.nodes[at] = (begin, end, build(begin, begin + half), build(begin + half, end))
            return at

        if len(ids):
            build(0, len(ids))
        self.ids, self.vectors = ids[order], vectors[order]
        self.centres, self.radii, self.least = np.array(centres), np.array(radii), np.array(least)

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Best (score, id) of each query, ``LOW`` where there are fewer than k; rows with the query's
        own id do not count.  ``floor``: a k-th score that is known already.  Third: leaves seen."""
        n = len(queries)
        score = np.full((n, k), LOW)
        ident = np.full((n, k), -1, dtype=np.int64)
        seen = 0
        if not self.nodes or not n:
            return score, ident, seen
        floats = queries.astype(np.float64)
        reach = np.sqrt((floats**2).sum(axis=1))
        # doubles round; the bound is widened by more than they can
        slack = 1e-9 * (reach * (np.sqrt((self.centres**2).sum(axis=1)).max() + self.radii.max()) + 1) + 1

        def bound(node: int, who: np.ndarray) -> np.ndarray:
            return floats[who] @ self.centres[node] + reach[who] * self.radii[node] + slack[who]

        stack = [(0, np.arange(n), bound(0, np.arange(n)))]
        while stack:
            node, who, upper = stack.pop()
            live = upper >= np.maximum(score[who, k - 1], floor[who])
            who = who[live]
            if not len(who):
                continue
            begin, end, left, right = self.nodes[node]
            if left < 0:
                seen += 1
                got = products(queries[who], self.vectors[begin:end])
                names = np.broadcast_to(self.ids[begin:end], got.shape)
                keep = names != own[who][:, None]
                all_s = np.concatenate([score[who], np.where(keep, got, LOW)], axis=1)
                all_i = np.concatenate([ident[who], np.where(keep, names, -1)], axis=1)
                # rows below the k-th best cannot come in; ties go to the smaller id
                cut = min(all_s.shape[1] - 1, k - 1)
                kth = -np.partition(-all_s, cut, axis=1)[:, cut]
                for row, q in enumerate(who):
                    at = np.flatnonzero((all_s[row] >= kth[row]) & (all_s[row] > LOW))
                    top = at[np.lexsort((all_i[row][at], -all_s[row][at]))[:k]]
                    score[q, : len(top)], ident[q, : len(top)] = all_s[row][top], all_i[row][top]
                continue
            a, b = bound(left, who), bound(right, who)
            first, second = ((left, a), (right, b)) if a.sum() >= b.sum() else ((right, b), (left, a))
            stack.append((second[0], who, second[1]))
            stack.append((first[0], who, first[1]))
        return score, ident, seen


def packed(rows: DataFrame, most: int, cells: int, trees: bool) -> DataFrame:
    """Runs of at most ``most`` neighbouring rows of ``rows`` (key, vec_id, q, dim), each with its centre, the radius
    around it and its largest squared norm; ``trees``: with a ball tree, else with the plain vectors."""
    import pyarrow as pa

    pivots: dict[int, np.ndarray] = {}
    # the rows of least hash, a bounded sample; a dimension that it misses is one cell
    for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * cells).select("dim", "q").collect():
        pivots.setdefault(r["dim"], []).append(r["q"])
    pivots = {d: spread_pivots(np.array(v, dtype=np.float64), cells) for d, v in pivots.items()}

    def matrix(column, dim):
        return column.flatten().to_numpy().reshape(-1, dim)

    @lean
    def assign(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cell, gap = np.zeros(len(dims), dtype=np.int32), np.zeros(len(dims))
            for d in np.unique(dims).tolist():
                mine = np.flatnonzero(dims == d)
                x = matrix(batch.column("q").take(pa.array(mine)), d).astype(np.float64)
                if d in pivots:
                    p = pivots[d]
                    cell[mine] = ((p**2).sum(axis=1) - 2 * (x @ p.T)).argmin(axis=1)
                    gap[mine] = np.sqrt(((x - p[cell[mine]]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(gap)], names=[*batch.schema.names, "cell", "gap"])

    @lean
    def build(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def one(dim, held):
            nonlocal number
            ids, keys, x = (np.concatenate(parts) for parts in zip(*held, strict=True))
            floats = x.astype(np.float64)
            centre = floats.mean(axis=0)
            number += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number - 1]), pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([keys], pa.list_(pa.int64())), pa.array([pickle.dumps(BallTree(ids, x) if trees else x)], pa.binary()),
                 pa.array([centre], pa.list_(pa.float64())), pa.array([float(np.sqrt(((floats - centre) ** 2).sum(axis=1)).max())]), pa.array([float((floats**2).sum(axis=1).max())])],
                names=[c.split()[0] for c in PACKED.split(", ")])

        held, size, now = [], 0, (-1, -1)
        for batch in batches:
            dims, cells_, ids, keys = (batch.column(c).to_numpy() for c in ("dim", "cell", "vec_id", "key"))
            at = 0
            while at < len(ids):
                place = (int(dims[at]), int(cells_[at]))
                if held and (place != now or size >= most):
                    yield one(now[0], held)
                    held, size = [], 0
                now = place
                ends = np.flatnonzero((dims[at:] != now[0]) | (cells_[at:] != now[1]))
                stop = min(at + int(ends[0]) if len(ends) else len(ids), at + most - size)
                held.append((ids[at:stop], keys[at:stop], matrix(batch.column("q").slice(at, stop - at), now[0])))
                size += stop - at
                at = stop
        if held:
            yield one(now[0], held)

    placed = rows.select("key", "vec_id", "q", "dim").mapInArrow(assign, "key long, vec_id long, q array<long>, dim int, cell int, gap double")
    ranged = placed.repartitionByRange("dim", "cell", "gap", "vec_id", "key").sortWithinPartitions("dim", "cell", "gap", "vec_id", "key")
    return materialize(ranged.mapInArrow(build, PACKED), "shards" if trees else "blocks")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 8192, block_rows: int = 512) -> DataFrame:
    """The k best candidates of each query by integer inner product.

    ``vectors`` and ``queries``: vec_id, q, dim (see ``quantized``). Returns query_id, rank, vec_id,
    score; ties go to the smaller vec_id, fewer candidates give fewer rows, and a query never meets
    its own id.  Vectors are compared only with vectors of their own dimension.  Rows that repeat a
    vec_id are one candidate, and one query, if they repeat the vector too; ids that repeat with other
    vectors are candidates and queries of their own, each query with ranks from 1.  Rows without an id take
    no part; empty tables give no rows.  Scores beyond 64 bits are clipped to the range of a long.  How many
    of the pairs of blocks and shards were searched is logged.
    """
    import pyarrow as pa

    spark = vectors.sparkSession
    small_batches(spark)
    number = F.monotonically_increasing_id().alias("key")  # kept as it is written with the blocks
    vectors = vectors.where("vec_id is not null and dim > 0").select("vec_id", "q", "dim").distinct().select(number, "vec_id", "q", "dim")
    queries = queries.where("vec_id is not null and dim > 0").select("vec_id", "q", "dim").distinct().select(number, "vec_id", "q", "dim")
    total, asked = vectors.count(), queries.count()
    if not total or not asked:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    cells = lambda n, most: min(MOST_CELLS, max(1, -(-4 * n // most)))
    shards = packed(vectors, shard_rows, cells(total, shard_rows), True)
    blocks = packed(queries, block_rows, cells(asked, block_rows), False)

    # the most that a block and a shard can give: |x||y| is split by centres and radii; doubles round by less than the rest
    balls = shards.select("dim", F.col("part").alias("shard"), F.col("centre").alias("c"), F.col("radius").alias("r"), F.col("top").alias("t"))
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    long_ = F.sqrt(dot("centre", "centre")), F.sqrt(dot("c", "c"))
    by_balls = dot("centre", "c") + long_[0] * F.col("r") + long_[1] * F.col("radius") + F.col("radius") * F.col("r")
    most = F.least(by_balls, F.sqrt(F.col("top") * F.col("t"))) + 1e-9 * (F.col("top") + F.col("t")) + 1
    by_bound = Window.partitionBy("block").orderBy(F.desc("most"), "shard")
    pairs = materialize(blocks.select("dim", F.col("part").alias("block"), "centre", "radius", "top").join(balls, "dim").select("block", "shard", most.alias("most")).withColumn(
        "nth", F.row_number().over(by_bound)), "pairs")

    def search(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                keys, ids, floors = (batch.column(c)[i].values.to_numpy() for c in ("keys", "ids", "floors"))
                x, tree = pickle.loads(batch.column("vectors")[i].as_py()), pickle.loads(batch.column("tree")[i].as_py())
                score, ident, _ = tree.search(x, ids, k, floors)
                row, col = np.nonzero(score > LOW)
                yield pa.RecordBatch.from_arrays([pa.array(keys[row]), pa.array(ids[row]), pa.array(ident[row, col]), pa.array(score[row, col])],
                                                 names=["key", "query_id", "vec_id", "score"])

    by = Window.partitionBy("key", "query_id").orderBy(F.desc("score"), "vec_id")
    none = F.lit(LOW).cast("long")
    rows = blocks.select(F.col("part").alias("block"), "ids", "keys", F.col("tree").alias("vectors"))
    members = blocks.select(F.col("part").alias("block"), F.posexplode("keys").alias("at", "key"))
    found, searched = None, 0
    for first, last in ((1, 1), (2, 8), (9, None)):
        wave = pairs.where(F.col("nth") >= first) if last is None else pairs.where(F.col("nth").between(first, last))
        if found is None:
            floors = rows.select("block", F.transform("keys", lambda _: none).alias("floors"), none.alias("worst"))
        else:
            kth = found.where(F.col("rank") == k).select("key", F.col("score").alias("kth"))
            held = members.join(kth, "key", "left").withColumn("kth", F.coalesce("kth", none))
            floors = held.groupBy("block").agg(  # the queries of a block
                F.transform(F.array_sort(F.collect_list(F.struct("at", "kth"))), lambda x: x["kth"]).alias("floors"), F.min("kth").alias("worst"))
        sent = materialize(wave.join(floors, "block").where("most >= worst").select("block", "shard", "floors"), "sent")
        if n := sent.count():
            searched += n
            given = sent.join(rows, "block").join(shards.select(F.col("part").alias("shard"), "tree"), "shard").select("keys", "ids", "floors", "vectors", "tree")
            new = given.mapInArrow(lean(search), "key long, query_id long, vec_id long, score long")
            new = new if found is None else new.unionByName(found.drop("rank"))
            found = materialize(new.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k), "found")
    log.info("top-k: %d of %d pairs of blocks and shards searched", searched, pairs.count())
    if found is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
