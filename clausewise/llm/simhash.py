"""Operator 4: SimHash near-duplicates by tiled exact comparison.

Fingerprints are 64-bit majority votes over the XXH64 hashes of word shingles.  Different
fingerprints are compared exactly, in tiles: 64-bit exclusive-or and bit counts in numpy.  Inside a
group the fingerprints are ordered by population count, and a pair of tiles is skipped when the
counts are further apart than the radius.  Groups come from bands: fingerprints that differ in at
most r bits agree on some b - r of b blocks, so every linked pair meets in some band, whatever the
number of rows.  A band that is too full is cut again by bands over its remaining bits, and those
again if they are too full.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, lean, materialize, small_batches, worker_for
from .components import connected_components

ALL = (1 << 64) - 1


def shingle_hashes(text: str, words: int = 4, seed: int = 42) -> np.ndarray:
    """Unsigned XXH64 of each shingle of ``text`` (A-Z lower-cased, ASCII white space)."""
    from xxhash import xxh64_intdigest as h

    parts = text.encode("utf-8").lower().split()
    n = len(parts)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    if n <= words:
        return np.array([h(b" ".join(parts), seed)], dtype=np.uint64)
    joined = b" ".join(parts)
    size = np.fromiter(map(len, parts), dtype=np.int64, count=n) + 1
    end = np.cumsum(size) - 1
    first = (end - size + 1)[: n - words + 1].tolist()
    last = end[words - 1 :].tolist()
    return np.array([h(joined[a:b], seed) for a, b in zip(first, last, strict=True)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    n = len(hashes)
    if not n:
        return 0
    votes = np.zeros(64, dtype=np.int64)
    for a in range(0, n, 1 << 15):
        votes += np.unpackbits(
            hashes[a : a + (1 << 15)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"
        ).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """(doc_id, fp) for every row; fp is the fingerprint as a signed long. A null text has none
    of the words and so the fingerprint zero."""

    @lean
    def run(batches):
        import pyarrow as pa

        worker_for("simhash")
        for batch in (g for b in batches for g in byte_groups(b)):
            fp = [majority(shingle_hashes(t or "", words)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(fp, dtype=np.uint64).view(np.int64))], names=["doc_id", "fp"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def blocks(mask: int, count: int) -> list[int]:
    """Cut the set bits of ``mask`` into ``count`` masks of about equal size."""
    bits = [i for i in range(64) if mask >> i & 1]
    cuts = [len(bits) * k // count for k in range(count + 1)]
    return [sum(1 << b for b in bits[cuts[k] : cuts[k + 1]]) for k in range(count)]


def band_masks(mask: int, radius: int, count: int) -> list[int]:
    """Every union of ``count - radius`` of ``count`` blocks."""
    return [sum(c) for c in combinations(blocks(mask, count), count - radius)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


class Links:
    """Union-find over the rows of one group, fed with arrays of index pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        a, b = self.label[i], self.label[j]
        differ = a != b
        if not differ.any():
            return
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        for x, y in np.unique(np.stack([a[differ], b[differ]], axis=1), axis=0).tolist():
            x, y = root(x), root(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
        change = np.arange(len(self.label))
        for x in list(parent):
            change[x] = root(x)
        self.label = change[self.label]


def tile_links(fp: np.ndarray, radius: int, tile: int = 512) -> np.ndarray:
    """Component label (an index) of each fingerprint, from exact comparison in tiles."""
    ones = np.bitwise_count(fp)
    order = np.argsort(ones, kind="stable")
    fp, ones = fp[order], ones[order].astype(np.int64)
    links = Links(len(fp))
    for a in range(0, len(fp), tile):
        left, top = fp[a : a + tile], ones[min(a + tile, len(fp)) - 1]
        for b in range(a, len(fp), tile):
            if ones[b] - top > radius:
                break
            i, j = np.nonzero(np.bitwise_count(left[:, None] ^ fp[None, b : b + tile]) <= radius)
            links.add(i + a, j + b)
    label = np.empty(len(fp), dtype=np.int64)
    label[order] = order[links.label]
    return label


def _compare(batches, radius: int):
    """Rows sorted by band: compare inside each band, give (a, b) pairs that connect what is linked."""
    import pyarrow as pa

    def within(band, fp):
        cut = np.flatnonzero((band[1:] != band[:-1]).any(axis=1)) + 1
        begin, stop = np.r_[0, cut], np.r_[cut, len(fp)]
        size = stop - begin
        a, b = [], []
        # bands of a few rows are one small tile each: all of them at once, by distance in the order
        small = np.repeat(size <= 48, size)
        group = np.repeat(np.arange(len(size)), size)
        for d in range(1, int(size[size <= 48].max(initial=1))):
            near = (group[d:] == group[:-d]) & small[d:]
            near[near] = np.bitwise_count(fp[d:][near] ^ fp[:-d][near]) <= radius
            a.append(fp[d:][near])
            b.append(fp[:-d][near])
        for g in np.flatnonzero(size > 48):
            own = fp[begin[g] : stop[g]]
            label = tile_links(own, radius)
            moved = np.flatnonzero(label != np.arange(len(own)))
            a.append(own[moved])
            b.append(own[label[moved]])
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(x).view(np.int64)) if x else pa.array([], pa.int64()) for x in (a, b)], names=["a", "b"])

    kept: list[tuple[np.ndarray, np.ndarray]] = []
    rows = 0
    for batch in batches:
        band = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1)], axis=1)
        kept.append((band, batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)))
        rows += len(band)
        if rows < 50_000:
            continue
        band, fp = (np.concatenate(x) for x in zip(*kept, strict=True))
        # the last band may go on in the next batch
        tail = len(band) - int(np.argmax((band[::-1] != band[-1]).any(axis=1))) if (band != band[-1]).any() else 0
        if tail:
            yield within(band[:tail], fp[:tail])
        kept, rows = [(band[tail:], fp[tail:])], len(band) - tail
    if rows:
        yield within(*(np.concatenate(x) for x in zip(*kept, strict=True)))


def near_links(fps: DataFrame, radius: int = 4, full: int = 4096, count: int | None = None, levels: int = 3) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints of ``fps`` (column fp) which differ in at most
    ``radius`` bits and together connect all that are linked.

    ``count`` is the number of blocks; by default it follows the number of fingerprints, so that
    a band holds a few of them on average.  Bands of more than ``full`` are cut again, up to
    ``levels`` times: fingerprints of a band agree on its bits, so they differ in at most the radius
    of the others.  All this changes the cost alone, never the links.
    """
    if count is None:
        n = fps.count()
        count = radius + 1 + (n > 1 << 20) + (n > 1 << 28)
    agreed = dict(enumerate(band_masks(ALL, radius, count)))  # bits that the fingerprints of a band share
    level = materialize(fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).cast("long").alias("t"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("v"))
        for t, m in agreed.items()])).alias("x")).select("x.t", "x.v", "fp"), "bands")
    ready: list[DataFrame] = []
    for _ in range(levels):
        crowded = level.groupBy("t", "v").agg(F.count("*").alias("n")).where(F.col("n") > full)
        # a band without enough bits left to cut stays as it is
        open_ = [t for t, m in agreed.items() if 64 - m.bit_count() > radius]
        crowded = materialize(crowded.where(F.col("t").isin(open_)).select("t", "v"), "crowded")
        open_ = [r["t"] for r in crowded.select("t").distinct().collect()]  # some of the masks
        if not open_:
            break
        ready.append(level.join(crowded, ["t", "v"], "left_anti"))
        finer, first = {}, max(agreed) + 1
        for t in open_:
            finer[t] = [(first + i, m) for i, m in enumerate(band_masks(ALL & ~agreed[t], radius, radius + 1))]
            first += len(finer[t])
        table = F.create_map(*[x for t, masks in finer.items() for x in (F.lit(t).cast("long"), F.array(*[
            F.struct(F.lit(k).cast("long").alias("t"), F.lit(signed(m)).alias("m")) for k, m in masks]))])
        level = materialize(level.join(crowded, ["t", "v"], "left_semi").select(
            "fp", "v", F.explode(F.element_at(table, F.col("t"))).alias("x")
        ).select(F.col("x.t").alias("t"), F.xxhash64("v", F.col("fp").bitwiseAND(F.col("x.m"))).alias("v"), "fp"), "bands")
        agreed = {k: agreed[t] | m for t, masks in finer.items() for k, m in masks}
    for part in ready:
        level = level.unionByName(part)
    return compared(level, radius)


def compared(banded: DataFrame, radius: int) -> DataFrame:
    return banded.repartition("t", "v").sortWithinPartitions("t", "v", "fp").mapInArrow(
        lambda batches: _compare(batches, radius), "a long, b long")


def near_duplicates(docs: DataFrame, words: int = 4, radius: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_id`` is
    the smallest doc_id that can be reached.  Equal fingerprints are one node, so copies are never
    paired.  Empty and null texts share the fingerprint zero; rows with a null doc_id take part but
    never name a component (null if no row of it has an id); rows that repeat stay; a long text is read whole; an empty table
    gives no rows; other columns are not read.
    """
    fps = materialize(fingerprints(docs, words), "fingerprints")
    nodes = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    reached = connected_components(near_links(nodes, radius))
    named = nodes.join(reached.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    table = named.select("fp", "component").join(least, "component").select("fp", "component_id")
    return fps.join(table, "fp").select("doc_id", "fp", "component_id")


def hex16(column: str):
    return F.lower(F.lpad(F.hex(column), 16, "0"))
