"""Operator 6: sequence packing as a cutting-stock problem solved by column generation.

A document's ids are cut at multiples of the sequence length; every full cut is a sequence of its
own and the rest is an item of the packing.  Items fall into length classes; the histogram over
classes (never more rows than classes) goes to the driver, where a linear program over patterns is
solved: a knapsack dynamic program prices new patterns, the fractional solution is rounded down and
what remains of the histogram is filled first-fit with the largest classes first.  Patterns are then
dealt to documents by their rank within the class, which is arithmetic on a small table.
"""

from __future__ import annotations

import logging
import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import ByteBpe
from .common import byte_groups, lean, materialize, small_batches

log = logging.getLogger(__name__)


def knapsack(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of the best multiset of classes within ``capacity``."""
    best = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    order = np.argsort(sizes, kind="stable")
    # a class that is worth no more than a smaller one is never needed
    order = order[values[order] > np.maximum.accumulate(np.r_[0.0, values[order]])[:-1]]
    w, v = sizes[order], values[order]
    upto = np.searchsorted(w, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if n := upto[c]:
            gain = v[:n] + best[c - w[:n]]
            j = gain.argmax()
            if gain[j] > best[c] + 1e-12:
                best[c], choice[c] = gain[j], order[j]
    counts = np.zeros(len(sizes), dtype=np.int64)
    c = capacity
    while c > 0:
        j = choice[c]
        if j < 0:
            c -= 1
            continue
        counts[j] += 1
        c -= int(sizes[j])
    return counts


def inverted(matrix: np.ndarray) -> np.ndarray:
    """Inverse by elimination with row pivots, in plain array operations: library threads of the
    linear algebra that numpy ships can hang in a process that also holds a JVM."""
    m = len(matrix)
    work = np.hstack([matrix, np.eye(m)])
    for k in range(m):
        best = k + int(np.abs(work[k:, k]).argmax())
        if best != k:
            work[[k, best]] = work[[best, k]]
        work[k] /= work[k, k]
        column = work[:, k].copy()
        column[k] = 0
        live = np.flatnonzero(column)
        work[live] -= column[live, None] * work[k]
    return work[:, m:]


def column_generation(demand: np.ndarray, sizes: np.ndarray, capacity: int, gap: float = 0.004,
                      rounds: int = 100_000) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Patterns and their fractional counts that cover ``demand`` at the least number of bins, and
    the gap to the bound that was reached (0: optimal).

    Revised simplex with an explicit inverse, refreshed now and then; the duals price the next
    pattern by ``knapsack``.  The best price also bounds the optimum from below (Farley), and the
    search ends once the bins are within ``gap`` of that bound; ``rounds`` only guards against
    cycling.
    """
    m = len(sizes)
    basis = [np.zeros(m, dtype=np.int64) for _ in range(m)]
    for i in range(m):
        basis[i][i] = max(1, min(capacity // int(sizes[i]), int(demand[i])))
    inverse = np.diag([1.0 / basis[i][i] for i in range(m)])
    x = (inverse * demand).sum(axis=1)
    bound, reached = 0.0, np.inf
    for step in range(rounds):
        duals = inverse.sum(axis=0)
        new = knapsack(duals, sizes, capacity)
        price = float(duals @ new)
        if price <= 1 + 1e-7:
            reached = 0.0
            break
        bound = max(bound, float(x.sum()) / price)
        reached = float(x.sum()) / bound - 1
        if reached <= gap:
            break
        direction = (inverse * new).sum(axis=1)
        down = direction > 1e-10
        if not down.any():
            break
        ratio = np.where(down, x / np.where(down, direction, 1), np.inf)
        out = int(np.argmin(ratio))
        x = x - ratio[out] * direction
        x[out] = ratio[out]
        x = np.maximum(x, 0)
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
        basis[out] = new
        if step % 400 == 399:
            inverse = inverted(np.array(basis, dtype=float).T)
            x = np.maximum((inverse * demand).sum(axis=1), 0)
    return [(b, float(v)) for b, v in zip(basis, x, strict=True) if v > 1e-9], reached


def plan(demand: np.ndarray, sizes: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Whole patterns: (count of each class, bins), covering every item exactly once."""
    left = demand.astype(np.int64).copy()
    out: list[tuple[np.ndarray, int]] = []
    if left.any():
        live = np.flatnonzero(left)
        found, reached = column_generation(left[live].astype(float), sizes[live], capacity)
        log.log(logging.INFO if reached <= 0.004 else logging.WARNING, "packing: bins within %.4f of the bound", reached)
        for pattern, share in sorted(found, key=lambda p: -p[1]):
            full = np.zeros(len(sizes), dtype=np.int64)
            full[live] = pattern
            used = full > 0
            n = min(int(share + 1e-6), int((left[used] // full[used]).min()))
            if n > 0:
                out.append((full, n))
                left -= full * n
    # the rest is bounded by the number of patterns: best combination of what is there, bin by bin
    while left.any():
        room, full = capacity, np.zeros(len(sizes), dtype=np.int64)
        reach = np.zeros(capacity + 1, dtype=np.int64) - 1  # class that first reaches a fill
        reach[0] = len(sizes)
        for j in np.flatnonzero(left)[::-1]:
            base = np.flatnonzero(reach >= 0)
            for k in range(1, min(int(left[j]), capacity // int(sizes[j])) + 1):
                new = base + k * int(sizes[j])
                new = new[new <= capacity]
                new = new[reach[new] < 0]
                if not len(new):
                    break
                reach[new] = j
        c = int(np.flatnonzero(reach >= 0)[-1])
        while c > 0:
            j = int(reach[c])
            full[j] += 1
            c -= int(sizes[j])
        full = np.minimum(full, left)
        n = int((left[full > 0] // full[full > 0]).min())
        out.append((full, n))
        left -= full * n
    return out


def planned(spark, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """``plan`` of classes 1 to ``capacity``, made by one task: executors hold linear algebra to one
    thread, and the driver stays free.  The plan has few more rows than classes."""

    @lean
    def run(batches):
        import pyarrow as pa

        for _ in batches:
            found = plan(demand, np.arange(1, capacity + 1), capacity)
            yield pa.RecordBatch.from_arrays(
                [pa.array([p.tolist() for p, _ in found], pa.list_(pa.int64())), pa.array([int(n) for _, n in found], pa.int64())], names=["pattern", "bins"])

    rows = spark.range(1).repartition(1).mapInArrow(run, "pattern array<long>, bins long").collect()
    return [(np.array(r["pattern"], dtype=np.int64), r["bins"]) for r in rows]


def pack(docs: DataFrame, tokenizer: str, length: int = 2048, grain: int = 8, end_id: int = 1) -> DataFrame:
    """Pieces of all documents, each in its place of a sequence.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, key.
    A null text is empty (the end id alone).  Rows are packed one by one: rows that repeat a
    doc_id, or have none, are documents of their own (``key`` tells the row).  Pieces of one
    length class are dealt in row order.  Long texts are encoded whole.  An empty table
    gives no pieces; other columns are not read.  ``grain`` is the width of a length class: an
    item may waste less than that, no class has more than ``length / grain`` rows in the plan.
    """
    small_batches(docs.sparkSession)

    @lean
    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = ByteBpe.load(tokenizer)
        part, row = TaskContext.get().partitionId(), 0
        seen: dict[int, int] = {}
        kinds = (pa.int64(),) * 6 + (pa.int32(), pa.int64())
        for batch in (g for b in batches for g in byte_groups(b, limit=2_000_000)):
            ids, bounds = encoder.encode(batch.column(1))
            raw = memoryview(np.insert(ids, bounds[1:], end_id).astype("<u4")).cast("B")
            bounds = (bounds + np.arange(len(bounds))).tolist()
            out: list[list] = [[] for _ in kinds]
            for name, begin, stop in zip(batch.column(0).to_pylist(), bounds, bounds[1:], strict=False):
                n = stop - begin
                for at in range(0, n, length):
                    size = min(length, n - at)
                    cls = -(-size // grain) if size < length else 0
                    seen[cls] = seen.get(cls, 0) + 1
                    for col, v in zip(out, (name, part << 33 | row, at, size, zlib.crc32(raw[4 * (begin + at) : 4 * (begin + at + size)]),
                                            n, cls, seen[cls] - 1), strict=True):
                        col.append(v)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, kinds, strict=True)],
                names=["doc_id", "key", "start", "length", "ids_crc32", "doc_tokens", "cls", "nth"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = materialize(
        texts.mapInArrow(cut, "doc_id long, key long, start long, length long, ids_crc32 long, doc_tokens long, "
                              "cls int, nth long"), "pieces")
    # rank within a class = pieces of the class in earlier tasks + the piece's number in its task
    task = F.shiftright("key", 33).alias("task")
    counts = pieces.groupBy("cls", task).agg(F.count("*").alias("n"))
    before = Window.partitionBy("cls").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    ranked = (
        pieces.withColumn("task", F.shiftright("key", 33)).join(first, ["cls", "task"])
        .withColumn("rank", F.col("first") + F.col("nth"))
    )
    classes = length // grain
    demand = np.zeros(classes + 1, dtype=np.int64)
    for cls, n in counts.groupBy("cls").agg(F.sum("n")).collect():  # at most length / grain + 1 rows
        demand[cls] = n
    sequence, rows = int(demand[0]), []  # whole cuts are the first sequences
    slot = np.zeros(classes, dtype=np.int64)
    for number, (pattern, bins) in enumerate(planned(docs.sparkSession, demand[1:], classes)):
        for j in np.flatnonzero(pattern):
            many = int(pattern[j]) * bins
            rows.append((int(j) + 1, int(slot[j]), int(slot[j]) + many, int(pattern[j]), sequence, number))
            slot[j] += many
        sequence += bins
    starts = {c: sorted(r for r in rows if r[0] == c) for c in {r[0] for r in rows}}
    table = {c: (np.array([r[1] for r in v]), np.array([r[3] for r in v]), np.array([r[4] for r in v])) for c, v in starts.items()}

    @lean
    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            cls, rank = batch.column("cls").to_numpy(), batch.column("rank").to_numpy()
            seq = rank.copy()
            for c in np.unique(cls[cls > 0]):
                at, per, base = table[int(c)]
                mine = cls == c
                k = np.searchsorted(at, rank[mine], side="right") - 1
                seq[mine] = base[k] + (rank[mine] - at[k]) // per[k]
            keep = batch.select(["doc_id", "key", "start", "length", "ids_crc32", "doc_tokens"])
            yield pa.RecordBatch.from_arrays([*keep.columns, pa.array(seq, pa.int64())], names=[*keep.schema.names, "sequence_id"])

    dealt = ranked.mapInArrow(
        deal, "doc_id long, key long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long")
    place = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "key", "start").rowsBetween(
        Window.unboundedPreceding, -1)
    return dealt.withColumn("offset", F.coalesce(F.sum("length").over(place), F.lit(0)))
