"""Near copies by SimHash and exact shingle similarity, for the pipeline's stage.

Texts are nodes (equal texts are one).  SimHash comes first: fingerprints over the word shingles are compared
exactly, in tiles (operator 4), and texts whose fingerprints the tiles link are verified and connected.  A pair at
similarity 0.8 differs in about ten bits, more than tiles can find without comparing all pairs, so an
exact check follows for what SimHash leaves apart.  Its candidates share one of ``BANDS`` bands of ``ROWS`` min-hashes
over word shingles; at similarity 0.8 a pair misses all of them with a chance of 3e-6.  Every candidate is
verified by the Jaccard similarity of its whole shingle sets.  Inside a band the nodes first meet
the smallest of it, so a group of copies costs one pair a node.  Those of bands that still hold several
components meet each other, but not all in a band: of the texts of one family most are below 0.8, and
two sets that reach it share one of their rarest shingles (a prefix in the order of rarity, whose length
follows from both sizes), first with the smallest holder of a shingle, then all that are still apart.
Nothing is left out but pairs that are connected already.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_groups, lean, materialize, small_batches, worker_for
from .components import connected_components
from .simhash import majority, near_links, shingle_hashes

BANDS, ROWS = 24, 4
#: Bits in which linked fingerprints differ at most.
RADIUS = 4


def min_hash_bands(hashes: np.ndarray) -> list[int]:
    """One signed hash a band; a text without words has bands of its own."""
    from xxhash import xxh64_intdigest as h

    rng = np.random.default_rng(42)
    a = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 4096):
        least = np.minimum(least, (a[:, None] * hashes[None, at : at + 4096] + b[:, None]).min(axis=1))
    raw = least.astype("<u8").tobytes()
    size = 8 * ROWS
    return np.array([h(raw[size * k : size * (k + 1)], k) for k in range(BANDS)], dtype=np.uint64).view(np.int64).tolist()


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two arrays of distinct hashes; two empty ones are alike."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def verified(pairs: DataFrame, docs: DataFrame, words: int, least: float) -> DataFrame:
    """Pairs (a, b) of ``pairs`` whose texts are similar; ``docs`` has row and text."""

    @lean
    def shingle(batches):
        import pyarrow as pa

        for batch in (g for b in batches for g in byte_groups(b)):
            sets = [np.unique(shingle_hashes(t, words)).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["row", "grams"])

    @lean
    def check(batches):
        import pyarrow as pa

        for batch in (b.slice(k, 200) for b in batches for k in range(0, b.num_rows, 200)):
            keep = [jaccard(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) >= least
                    for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("row")).unionByName(pairs.select(F.col("b").alias("row"))).distinct()
    sets = materialize(docs.join(wanted, "row", "left_semi").groupBy("row").agg(F.first("text").alias("text"))
                       .mapInArrow(shingle, "row long, grams binary"), "shingles")
    both = pairs.join(sets.select(F.col("row").alias("a"), F.col("grams").alias("x")), "a").join(
        sets.select(F.col("row").alias("b"), F.col("grams").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def rare_shingles(rows: DataFrame, docs: DataFrame, words: int, least: float) -> DataFrame:
    """(row, c, m, at, gram): of each of ``rows`` (row, c) the shingles among its rarest m - ceil(least m) + 1 that
    another row holds too; m different shingles, the rarest (over these rows) at place 0."""

    @lean
    def shingle(batches):
        import pyarrow as pa

        for batch in (g for b in batches for g in byte_groups(b, 2)):
            sets = [np.unique(shingle_hashes(t, words)) for t in batch.column(2).to_pylist()]
            size = np.array([len(x) for x in sets], dtype=np.int64)
            bounds = pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32))
            grams = pa.array(np.concatenate([np.zeros(0, dtype=np.uint64), *sets]).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()), pa.ListArray.from_arrays(bounds, grams)],
                                             names=["row", "c", "m", "grams"])

    texts = docs.join(rows, "row").groupBy("row").agg(F.first("c").alias("c"), F.first("text").alias("text"))
    held = materialize(texts.mapInArrow(shingle, "row long, c long, m long, grams array<long>"), "sets").select("row", "c", "m", F.explode("grams").alias("gram"))
    counts = held.groupBy("gram").agg(F.count("*").alias("n"))
    ordered = held.join(counts, "gram").withColumn("at", F.row_number().over(Window.partitionBy("row").orderBy("n", "gram")) - 1)
    return ordered.where((F.col("n") > 1) & (F.col("at") <= F.col("m") - F.ceil(F.col("m") * least - 1e-9))).select("row", "c", "m", "at", "gram")


def sharing(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b): rows of different components that share one of their rarest shingles, few enough of them for both
    sizes: sets that reach the similarity hold at least (m + n) least / (1 + least) shingles in common, so
    the first common one in the order of rarity lies before the last that many of each."""
    x, y = left.alias("x"), right.alias("y")
    both = F.ceil((F.col("x.m") + F.col("y.m")) * (least / (1 + least)) - 1e-9)
    pairs = x.join(y, (F.col("x.gram") == F.col("y.gram")) & (F.col("x.c") != F.col("y.c")) & (F.col("x.row") < F.col("y.row"))
                   & (F.col("x.at") <= F.col("x.m") - both) & (F.col("y.at") <= F.col("y.m") - both))
    return materialize(pairs.select(F.col("x.row").alias("a"), F.col("y.row").alias("b")).distinct(), "sharing")


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """(a, b): rows of ``nodes`` (row, fp) that the tiles of SimHash link, each with one that stands for its fingerprint;
    rows of one fingerprint meet the least of them."""
    named = materialize(nodes.groupBy("fp").agg(F.min("row").alias("least")), "fingerprints")
    same = nodes.join(named, "fp").where("row <> least").select(F.col("least").alias("a"), F.col("row").alias("b"))
    near = near_links(named, RADIUS)
    x, y = (named.select(F.col("fp").alias(c), F.col("least").alias(r)) for c, r in (("a", "x"), ("b", "y")))
    other = near.join(x, "a").join(y, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    return materialize(same.unionByName(other).distinct(), "fingerprint-pairs")


def similar_components(docs: DataFrame, words: int = 5, least: float = 0.8) -> DataFrame:
    """(row, component) for every distinct text of ``docs`` (columns row, text; no nulls), linked
    where the similarity of the sets of ``words``-word shingles is at least ``least``."""

    @lean
    def sketch(batches):
        import pyarrow as pa

        worker_for("near_copies")
        for batch in (g for b in batches for g in byte_groups(b)):
            hashes = [shingle_hashes(t, words) for t in batch.column(1).to_pylist()]
            found = [min_hash_bands(h) for h in hashes]
            fp = np.array([majority(h) for h in hashes], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), pa.array(found, pa.list_(pa.int64()))], names=["row", "fp", "bands"])

    small_batches(docs.sparkSession)
    nodes = materialize(docs.select("row", "text").mapInArrow(sketch, "row long, fp long, bands array<long>")
                        .groupBy("row").agg(F.first("fp").alias("fp"), F.first("bands").alias("bands")), "sketches")
    links = materialize(verified(fingerprint_pairs(nodes.select("row", "fp")), docs, words, least), "links")
    linked = materialize(connected_components(links), "known")
    banded = nodes.select("row", F.explode("bands").alias("band"))
    firsts = banded.groupBy("band").agg(F.min("row").alias("a"), F.max("row").alias("last")).where("a < last").select("band", "a")
    met = materialize(banded.join(firsts, "band"), "met")
    star = met.where("a < row").select("a", F.col("row").alias("b")).distinct()
    # what SimHash has connected needs no more pairs
    a, b = (linked.select(F.col("node").alias(c), F.col("component").alias(d)) for c, d in (("a", "c"), ("b", "d")))
    star = star.join(a, "a", "left").join(b, "b", "left").where(F.coalesce("c", "a") != F.coalesce("d", "b")).select("a", "b")
    links = materialize(links.unionByName(verified(materialize(star, "star"), docs, words, least)), "links")
    known = materialize(connected_components(links), "known")
    parts = met.join(known.withColumnRenamed("node", "row"), "row", "left").select(
        "band", "row", "a", F.coalesce("component", "row").alias("c"))
    several = parts.groupBy("band").agg(F.min("c").alias("p"), F.max("c").alias("q")).where("p < q").select("band")
    # the first of a band has met all others
    apart = materialize(parts.join(several, "band", "left_semi").where("row <> a").select("row", "c").distinct(), "open")
    if not apart.isEmpty():
        marks = materialize(rare_shingles(apart, docs, words, least), "rare")
        heads = marks.groupBy("gram").agg(F.min(F.struct("row", "c", "m", "at")).alias("h"), F.min("c").alias("p"), F.max("c").alias("q")).where("p < q").select(
            "gram", "h.*").toDF("gram", "row", "c", "m", "at")
        found = materialize(verified(sharing(heads, marks, least), docs, words, least), "links")
        links = materialize(links.unionByName(found), "links")
        known = materialize(connected_components(links), "known")
        # what a common first has connected needs no more pairs
        marks = marks.drop("c").join(known.select(F.col("node").alias("row"), F.col("component").alias("c")), "row", "left").withColumn("c", F.coalesce("c", "row"))
        open_ = materialize(marks.join(marks.groupBy("gram").agg(F.min("c").alias("p"), F.max("c").alias("q")).where("p < q").select("gram"), "gram", "left_semi"), "rare")
        links = materialize(links.unionByName(verified(sharing(open_, open_, least), docs, words, least)), "links")
        known = connected_components(links)
    return nodes.select("row").join(known.withColumnRenamed("node", "row"), "row", "left").withColumn(
        "component", F.coalesce("component", "row"))
