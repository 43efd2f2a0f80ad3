"""Inner products of vectors without comparing all pairs: a metric index of packed chunks.

Rows go to the cell of their nearest pivot (pivots are spread over a bounded sample) and are range-sorted
by cell and distance from the pivot, so a cell of any size is cut into chunks of bounded size.  A chunk is
one row: its vectors packed as an array, their centre and the radius around it.  Two vectors of norms u and v
at a distance of at least g have an inner product of at most (u^2 + v^2 - g^2) / 2, and by the triangle
inequality g is at least the distance of the centres less both radii.  That bound, first against whole
cells and then against chunks, leaves the chunk pairs that can hold a wanted pair; only those are multiplied,
as arrays inside a task.  Pairs alone are shuffled: tasks read the vectors from the chunk files, in the
shared folder, so the disk holds each vector once, however many pairs its chunk has.  Nothing is lost: the
bound is never below a product.
"""

from __future__ import annotations

import logging
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise.sources.shared import fresh

log = logging.getLogger(__name__)
CHUNK = "chunk long, cell int, n int, ids array<long>, vectors binary, centre array<double>, radius double, norm double, reach double"
MOST_CELLS = 1024
#: Chunks that a task holds at once, and those that it meets before the next task goes on.
HELD, MET = 8, 256
ROW_GROUPS = {"parquet.block.row.count.limit": HELD}
#: Chunks whose centres may be sent to all executors, some 600 bytes each for vectors of 64.
MOST_SENT = 16_384
#: Rows of a product that is held at once, and the most that a task of ``best_above`` asks for.
TILE, STACK, ASKED = 512, 2048, 8192


def stored(df: DataFrame, label: str, **options) -> DataFrame:
    """``df`` written to the shared folder and read back; it goes when the session ends, or by ``dropped``."""
    path = fresh(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._own_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete what ``stored`` wrote for ``df``; only for a table that nothing reads any more."""
    if not hasattr(df, "_own_path"):  # an empty table that was never written
        return
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._own_path)
    at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


@dataclass
class Chunks:
    """``table``: one row a chunk; of each cell its pivot, the longest distance from it, the largest squared norm;
    ``place``: the folder of the chunk files, with a folder a chunk if they are ``apart``."""

    table: DataFrame
    pivots: np.ndarray
    reach: np.ndarray
    norm: np.ndarray
    count: int
    place: str = ""
    apart: bool = False


def spread_pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` rows of ``sample``, each the farthest from those before it."""
    chosen, gap = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(sample)) and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[chosen[-1]]) ** 2).sum(axis=1))
    return sample[chosen]


def matrix(column) -> np.ndarray:
    rows = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1) if rows else np.zeros((0, 0))


def pack(rows: DataFrame, cells: int | None = None, chunk_bytes: int = 1 << 20, pivots: np.ndarray | None = None) -> Chunks:
    """``rows``: seq (unique long) and embedding (doubles, one length for all).  ``cells``: by default the square
    root of the rows, 1,024 at most; ``pivots``: by default from the four rows a cell of least hash."""
    import pyarrow as pa

    rows = rows.select(F.col("seq").cast("long").alias("seq"), F.col("embedding").cast("array<double>").alias("embedding"))
    if pivots is None:
        cells = cells or min(MOST_CELLS, max(1, math.isqrt(rows.count())))
        sample = rows.orderBy(F.xxhash64("seq"), "seq").limit(4 * cells).select("embedding").collect()  # bounded by the cells
        if not sample:
            return Chunks(rows.sparkSession.createDataFrame([], CHUNK), np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0)
        pivots = spread_pivots(np.array([r["embedding"] for r in sample], dtype=np.float64), cells)

    def assign(batches):
        for batch in batches:
            x = matrix(batch.column(1))
            if not len(x):
                continue
            cell = ((pivots**2).sum(axis=1) - 2 * (x @ pivots.T)).argmin(axis=1)
            gap = np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(gap)], names=["seq", "embedding", "cell", "gap"])

    def build(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0

        def chunk(cell, held):
            nonlocal number
            ids, x = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            centre = x.mean(axis=0)
            row = {"chunk": [part << 32 | number], "cell": pa.array([cell], pa.int32()), "n": pa.array([len(ids)], pa.int32()), "ids": pa.array([ids], pa.list_(pa.int64())),
                   "vectors": [x.tobytes()], "centre": [centre], "radius": [float(np.sqrt(((x - centre) ** 2).sum(axis=1)).max())],
                   "norm": [float((x**2).sum(axis=1).max())], "reach": [max(h[2] for h in held)]}
            number += 1
            return pa.RecordBatch.from_pydict(row)

        held, size, now = [], 0, -1
        for batch in batches:
            ids, x, cell, gap = batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy(), batch.column(3).to_numpy()
            most = max(64, chunk_bytes // (8 * max(1, x.shape[1])))
            at = 0
            while at < len(ids):
                if cell[at] != now or size == most:
                    if held:
                        yield chunk(now, held)
                    held, size, now = [], 0, int(cell[at])
                to = min(at + most - size, at + int(np.searchsorted(cell[at:], now, side="right")))
                held.append((ids[at:to], x[at:to], float(gap[at:to].max())))
                size += to - at
                at = to
        if held:
            yield chunk(now, held)

    placed = rows.mapInArrow(assign, "seq long, embedding array<double>, cell int, gap double")
    ranged = placed.repartitionByRange("cell", "gap", "seq").sortWithinPartitions("cell", "gap", "seq")
    table = stored(ranged.mapInArrow(build, CHUNK), "chunks", **ROW_GROUPS)
    reach, norm = np.full(len(pivots), -1.0), np.zeros(len(pivots))
    count = 0
    for r in table.groupBy("cell").agg(F.max("reach").alias("reach"), F.max("norm").alias("norm"), F.count("*").alias("n")).collect():  # a row a cell
        reach[r["cell"]], norm[r["cell"]] = r["reach"], r["norm"]
        count += r["n"]
    return Chunks(table, pivots, reach, norm, count, table._own_path)


def bound(far: Column) -> Column:
    """The most that an inner product can be; a little is added for what doubles round."""
    gap = F.greatest(F.lit(0.0), far - F.col("radius") - F.col("radius2"))
    return (F.col("norm") + F.col("norm2") - gap * gap) / 2 + 1e-9 * (F.col("norm") + F.col("norm2") + 1)


def candidates(left: Chunks, right: Chunks, least: float | DataFrame) -> DataFrame:
    """(a, b, most): chunks of ``left`` and ``right`` that can hold a product of at least ``least``, and the most that it can be;
    ``least`` is one number, or a table (chunk, least) for the chunks of ``left`` that ask at all."""
    import pyarrow as pa

    pivots, reach, norm = right.pivots, right.reach, right.norm
    asking = left.table.select("chunk", "centre", "radius", "norm")
    asking = asking.join(least, "chunk") if isinstance(least, DataFrame) else asking.withColumn("least", F.lit(float(least)))

    def probe(batches):
        for batch in batches:
            c, r, w, low = matrix(batch.column(1)), *(batch.column(k).to_numpy() for k in (2, 3, 4))
            if not len(c):
                continue
            far = np.sqrt(np.maximum(0, (c**2).sum(axis=1)[:, None] - 2 * c @ pivots.T + (pivots**2).sum(axis=1)))
            gap = np.maximum(0, far - 1e-6 * (far + 1) - r[:, None] - np.maximum(reach, 0))
            live = ((w[:, None] + norm - gap**2) / 2 + 1e-9 * (w[:, None] + norm + 1) >= low[:, None]) & (reach >= 0)
            row, cell = np.nonzero(live)
            yield pa.RecordBatch.from_arrays([*(x.take(pa.array(row)) for x in batch.columns), pa.array(cell, pa.int32())],
                                             names=["a", "centre", "radius", "norm", "least", "cell"])

    asked = asking.select("chunk", "centre", "radius", "norm", "least").mapInArrow(
        probe, "a long, centre array<double>, radius double, norm double, least double, cell int")
    known = right.table.select("cell", F.col("chunk").alias("b"), F.col("centre").alias("centre2"), F.col("radius").alias("radius2"), F.col("norm").alias("norm2"))
    # what is asked holds a centre for every live cell, so it should not be shuffled
    known = F.broadcast(known) if right.count <= MOST_SENT else known
    far = F.sqrt(F.aggregate(F.zip_with("centre", "centre2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    return asked.join(known, "cell").withColumn("most", bound(far)).where("most >= least").select("a", "b", "most")


def chunks_in(place: str, apart: bool, wanted: np.ndarray):
    """(chunk, ids, vectors) of the ``wanted`` chunks (ascending) from their files; other row groups are not read."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    store, root = fs.FileSystem.from_uri(place if "://" in place else "file://" + place.removeprefix("file:"))
    # a chunk's number begins with that of the task that wrote it, and so of its file
    under = [(f"{root}/chunk={c}", "part-", [c]) for c in wanted.tolist()] if apart else [
        (root, f"part-{part:05d}-", wanted[wanted >> 32 == part].tolist()) for part in np.unique(wanted >> 32).tolist()]
    listed: dict[str, list[str]] = {}
    for folder, name, own in under:
        if folder not in listed:
            listed = {folder: sorted(x.path for x in store.get_file_info(fs.FileSelector(folder)) if x.path.endswith(".parquet"))}
        found = 0
        for path in (x for x in listed[folder] if x.rsplit("/", 1)[1].startswith(name)):
            with store.open_input_file(path) as f:
                file = pq.ParquetFile(f)
                for g in range(file.num_row_groups):
                    held = own if apart else file.read_row_group(g, ["chunk"]).column(0).to_pylist()
                    if not (take := [k for k, c in enumerate(held) if c in own]):
                        continue
                    rows = file.read_row_group(g, ["ids", "vectors"]).take(take).to_batches()
                    at = iter(take)
                    for batch in rows:
                        for k in range(batch.num_rows):
                            ids = batch.column("ids")[k].values.to_numpy()
                            yield held[next(at)], ids, np.frombuffer(batch.column("vectors")[k].as_buffer()).reshape(len(ids), -1)
                            found += 1
        if found != len(own):
            raise RuntimeError(f"{found} of {len(own)} chunks in {folder}")


def multiply(pairs: DataFrame, left: Chunks, right: Chunks, run, schema: str) -> DataFrame:
    """``run`` of the ids and vectors of both chunks of every pair, as record batches of ``schema``.  A task holds
    ``HELD`` neighbouring chunks of the left and reads those of the right that they meet one after another."""
    of_left, of_right = (left.place, left.apart), (right.place, right.apart)

    def met(pairs):
        a = {c: (ids, x) for c, ids, x in chunks_in(*of_left, np.unique(pairs[:, 0]))}
        for c, y_ids, y in chunks_in(*of_right, np.unique(pairs[:, 1])):
            for own in pairs[pairs[:, 1] == c, 0].tolist():
                x_ids, x = a[own]
                if (out := run(x_ids, y_ids, x @ y.T, own == c)) is not None:
                    yield out

    def products(batches):
        key, held = None, []
        for batch in batches:
            for row in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                if row[:2] != key:
                    if held:
                        yield from met(np.array(held))
                    key, held = row[:2], []
                held.append(row[2:])
        if held:
            yield from met(np.array(held))

    keyed = pairs.select(F.shiftright("a", HELD.bit_length() - 1).alias("x"), F.shiftright("b", MET.bit_length() - 1).alias("y"), "a", "b")
    tasks = min(4096, math.ceil(max(1, left.count) / HELD) * math.ceil(max(1, right.count) / MET) * 2)
    return keyed.repartition(tasks, "x", "y").sortWithinPartitions("x", "y").mapInArrow(products, schema)


def _within(rows: DataFrame, least: float) -> tuple[Chunks, DataFrame]:
    chunks = pack(rows)
    pairs = stored(candidates(chunks, chunks, least).where("a <= b").select("a", "b"), "chunk-pairs") if chunks.count else chunks.table.selectExpr("chunk a", "chunk b")
    log.info("metric join: %d of %d chunk pairs", pairs.count(), chunks.count * (chunks.count + 1) // 2)
    return chunks, pairs


def pairs_above(rows: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity), a < b, for all pairs of ``rows`` with an inner product above ``least``."""
    import pyarrow as pa

    def run(x, y, s, same):
        r, c = np.nonzero(s > least)
        a, b, s = x[r], y[c], s[r, c]
        keep = a < b if same else a != b
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)[keep]), pa.array(np.maximum(a, b)[keep]), pa.array(s[keep])], names=["a", "b", "similarity"])

    chunks, pairs = _within(rows, least)
    return multiply(pairs, chunks, chunks, run, "a long, b long, similarity double")


def links_above(rows: DataFrame, least: float) -> DataFrame:
    """(a, b): edges that connect whatever pairs above ``least`` connect; of a chunk pair no more than it has
    rows, however many pairs it holds."""
    import pyarrow as pa

    def run(x, y, s, same):
        near = s > least
        if not near.any():
            return None
        far = np.iinfo(np.int64).max
        of_x, of_y = x.copy(), np.where(near.any(axis=0), y, far)
        if same:
            of_y = of_x = x.copy()
        while True:  # the least id that is reached, from one side to the other
            new_y = np.minimum(of_y, np.where(near, of_x[:, None], far).min(axis=0))
            new_x = np.minimum(of_x, np.where(near, new_y[None, :], far).min(axis=1))
            if (new_x == of_x).all() and (new_y == of_y).all():
                break
            of_x, of_y = new_x, (new_x if same else new_y)
        ids, names = np.concatenate([x, y]), np.concatenate([of_x, of_y])
        keep = (names < ids) & (names != far)
        return pa.RecordBatch.from_arrays([pa.array(names[keep]), pa.array(ids[keep])], names=["a", "b"])

    chunks, pairs = _within(rows, least)
    return multiply(pairs, chunks, chunks, run, "a long, b long")


def _best(x, y, s, same):
    import pyarrow as pa

    own = x[:, None] == y[None, :]
    s = np.where(own, -np.inf, s)
    most = s.max(axis=1, initial=-np.inf)
    other = np.where(s == most[:, None], y[None, :], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
    keep = np.isfinite(most)
    return pa.RecordBatch.from_arrays([pa.array(x[keep]), pa.array(other[keep]), pa.array(most[keep])], names=["seq", "other", "similarity"])


def _reduced(found: DataFrame) -> DataFrame:
    return found.groupBy("seq").agg(F.min_by(F.struct("other", "similarity"), F.struct(-F.col("similarity"), "other")).alias("r")).select("seq", "r.other", "r.similarity")


BEST = "seq long, other long, similarity double"


def closer(x, x_ids, y, y_ids, best, other, at, base: int = 0) -> None:
    """Bring ``best`` (at first the product to be exceeded), ``other`` (an id of ``y``, the least among equals) and ``at``
    (its place in ``y`` plus ``base``, at first -1) of the rows of ``x`` up to date with the rows of ``y``; equal ids do not meet.

    ``x`` and ``y`` are pairs: the doubles, and the floats that ``halved`` makes.  Products of floats, which may be off by
    ``slack``, tell where a better one can be, and those few are taken again from the doubles, always in the same
    order, so that a product does not depend on the side or place of its rows.
    """
    (x, x32), (y, y32) = x, y
    if not len(x) or not len(y):
        return
    slack = 1e-30 + (x.shape[1] + 8) * 2.0**-22 * math.sqrt(float((x**2).sum(axis=1).max()) * float((y**2).sum(axis=1).max()))
    for j in range(0, len(y), STACK):
        ids = y_ids[j : j + STACK]
        order = np.argsort(ids)
        for i in range(0, len(x), TILE):
            s = x32[i : i + TILE] @ y32[j : j + STACK].T
            own = x_ids[i : i + TILE]
            k = order[np.minimum(np.searchsorted(ids, own, sorter=order), len(ids) - 1)]
            same = np.flatnonzero(ids[k] == own)
            s[same, k[same]] = -np.inf
            most, now = s.max(axis=1).astype(np.float64), best[i : i + TILE]
            rows = np.flatnonzero((most >= now - slack) & (most > -np.inf))
            if not len(rows):
                continue
            low = np.maximum(now[rows], most[rows]) - slack
            r, c = np.nonzero(s[rows] >= low.astype(s.dtype)[:, None])
            r = rows[r]
            for e in range(0, len(r), 1 << 16):
                q, d = r[e : e + (1 << 16)] + i, c[e : e + (1 << 16)] + j
                p, name = (x[q] * y[d]).sum(axis=1), y_ids[d]
                turn = np.lexsort((name, -p, q))
                turn = turn[np.r_[True, np.diff(q[turn]) > 0]]
                q, d, p, name = q[turn], d[turn], p[turn], name[turn]
                take = (p > best[q]) | (p == best[q]) & (at[q] >= 0) & (name < other[q])
                q = q[take]
                best[q], other[q], at[q] = p[take], name[take], d[take] + base


def halved(x: np.ndarray) -> np.ndarray:
    """``x`` as floats, unless a product could leave their range."""
    return x if np.abs(x).max(initial=0) > 1e15 else x.astype(np.float32)


def best_above(left: Chunks, right: Chunks, least: float) -> DataFrame:
    """(seq, other, similarity): for the rows of ``left`` the row of ``right`` of another seq with the largest
    product, the least seq among equals, where that is above ``least``.

    A task asks for a few neighbouring chunks, reads the chunks of the right whose bound reaches ``least`` and what
    is found already one after another, and returns a row for each of its own that has one, so nothing
    is shuffled. The centres of up to ``MOST_SENT`` chunks are sent to the tasks; beyond that, pairs are joined.
    """
    import pyarrow as pa

    spark = left.table.sparkSession
    if not left.count or not right.count:
        return spark.createDataFrame([], BEST)
    if max(left.count, right.count) > MOST_SENT:
        return _reduced(multiply(candidates(left, right, least).select("a", "b"), left, right, _best, BEST)).where(F.col("similarity") > least)

    def known(chunks):
        rows = chunks.table.select("chunk", "n", "centre", "radius", "norm").orderBy("chunk").collect()  # MOST_SENT at most
        return [np.array([r[k] for r in rows]) for k in range(5)]

    of_left = known(left)
    of_right = of_left if right is left else known(right)
    paths = (left.place, left.apart), (right.place, right.apart)
    total = int(of_left[1].sum())
    each = min(ASKED, max(TILE, total // (4 * spark.sparkContext.defaultParallelism)))
    group = (np.cumsum(of_left[1]) - of_left[1]) // each
    tasks = int(group[-1]) + 1

    def asked(batches):
        for batch in batches:
            for task in batch.column(0).to_pylist():
                yield from answers(np.flatnonzero(group == task))

    def answers(mine):
        if not len(mine):
            return
        _, n, centre, radius, norm = (v[mine] for v in of_left)
        chunk2, _, centre2, radius2, norm2 = of_right
        far = np.sqrt(np.maximum(0, (centre**2).sum(axis=1)[:, None] - 2 * centre @ centre2.T + (centre2**2).sum(axis=1)))
        gap = np.maximum(0, far - 1e-6 * (far + 1) - radius[:, None] - radius2)
        both = norm[:, None] + norm2
        most = (both - gap**2) / 2 + 1e-9 * (both + 1)
        held = list(chunks_in(*paths[0], of_left[0][mine]))
        ids, x = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        # the files may give the chunks in another order than their numbers
        back = {c: k for k, c in enumerate(of_left[0][mine].tolist())}
        turn = np.array([back[h[0]] for h in held])
        most, ends = most[turn], np.cumsum([len(h[1]) for h in held])
        begins = ends - n[turn]
        held.clear()
        x32 = halved(x)
        best, other, at = np.full(len(x), float(least)), np.zeros(len(x), dtype=np.int64), np.full(len(x), -1)

        def meet(stack):
            y_ids, y = np.concatenate([h[1] for h in stack]), np.concatenate([h[2] for h in stack])
            reach = most[:, [h[0] for h in stack]].max(axis=1)
            live = reach >= np.minimum.reduceat(best, begins)
            y = y, halved(y)
            run = np.flatnonzero(np.diff(np.r_[False, live, False].astype(np.int8)))
            for a, b in zip(run[::2], run[1::2], strict=True):  # neighbours together
                rows = slice(begins[a], ends[b - 1])
                closer((x[rows], x32[rows]), ids[rows], y, y_ids, best[rows], other[rows], at[rows])

        stack, size = [], 0
        place = {c: k for k, c in enumerate(chunk2.tolist())}
        for c, y_ids, y in chunks_in(*paths[1], chunk2[(most >= least).any(axis=0)]):
            stack.append((place[c], y_ids, y))
            size += len(y_ids)
            if size >= STACK:
                meet(stack)
                stack, size = [], 0
        if stack:
            meet(stack)
        found = at >= 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[found]), pa.array(other[found]), pa.array(best[found])], names=["seq", "other", "similarity"])

    return spark.range(0, tasks, 1, tasks).mapInArrow(asked, BEST)


def best_other(rows: DataFrame, least: float) -> DataFrame:
    """(seq, other, similarity): the row with the largest product, where it is above ``least``.  The products within
    a chunk come first; a chunk then asks only chunks whose bound reaches the worst best of its rows."""
    chunks = pack(rows)
    if not chunks.count:
        return rows.sparkSession.createDataFrame([], BEST)
    own = chunks.table.selectExpr("chunk a", "chunk b")
    first = stored(_reduced(multiply(own, chunks, chunks, _best, BEST)), "best-in-chunk")
    members = chunks.table.select("chunk", F.explode("ids").alias("seq"))
    floor = members.join(first, "seq", "left").groupBy("chunk").agg(
        F.greatest(F.min(F.coalesce("similarity", F.lit(float(least)))), F.lit(float(least))).alias("least"))
    rest = candidates(chunks, chunks, stored(floor, "floors")).where("a <> b").select("a", "b")
    return _reduced(first.unionByName(multiply(rest, chunks, chunks, _best, BEST))).where(F.col("similarity") > least)

