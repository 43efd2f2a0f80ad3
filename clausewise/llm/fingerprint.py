"""Operator 9: threshold-scaled document fingerprints, DataFrame functions only.

The sketch of a document is the set of its word-shingle hashes below a fixed fraction of the hash
range (one in ``2 ** bits``), whatever its size.  Whether a hash is kept depends on the hash alone,
so the sketch of two texts together is the union of their sketches, and the share of common hashes
estimates containment, however unequal the sizes.  For a true containment c in a text of n
different shingles the estimate has a standard deviation of sqrt(c (1 - c) (2 ** bits - 1) / n); a
text that is wholly contained is estimated at exactly 1 unless none of its hashes is kept, which
has a chance of (1 - 2 ** -bits) ** n: with one bit, 0.4 % for eight shingles, with two 0.3 % for twenty.  A text none of
whose hashes is below the fraction keeps its least hash, so that it still equals its copies.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import resolved


def below(hashes: Column, bits: int) -> Column:
    return F.filter(hashes, lambda h: F.shiftrightunsigned(h, 64 - bits) == 0)


def thinned(hashes: Column, bits: int) -> Column:
    """Sorted different hashes below the fraction, or the least one if there are none."""
    low = below(hashes, bits)
    return F.array_sort(F.array_distinct(F.when((F.size(low) > 0) | (F.size(hashes) == 0), low).otherwise(F.array(F.array_min(hashes)))))


def sketch(text: Column, words: int = 5, bits: int = 1) -> Column:
    """The sorted kept hashes of the lower-cased words' shingles (fewer words: of all of them)."""
    parts = F.filter(F.split(F.lower(text), r"[\s]+"), lambda w: w != "")

    def of(p: Column) -> Column:
        n = F.greatest(F.size(p) - (words - 1), F.least(F.size(p), F.lit(1)))
        index = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(index, lambda i: F.xxhash64(*[F.get(p, i + k) for k in range(words)]))

    # the words and hashes are used several times: one-element arrays hold them, so each is made once
    hashes = F.transform(F.array(parts), of)
    return F.element_at(F.transform(hashes, lambda h: thinned(h, bits)), 1)


def likeness(a: Column, b: Column) -> Column:
    """Common hashes over the smaller sketch (the larger containment), 0 to 1; a sketch without
    hashes, of a text without words, is like another such one alone."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).when(F.size(a) + F.size(b) == 0, 1.0).otherwise(0.0)


def as_text(x: Column) -> Column:
    """The fingerprint: the low 48 bits of each hash as 12 hexadecimal digits; the likenesses are those of
    the whole hashes."""
    return F.array_join(F.transform(x, lambda h: F.lpad(F.hex(h.bitwiseAND(F.lit((1 << 48) - 1))), 12, "0")), "")


def merge(a: Column, b: Column, bits: int = 1) -> Column:
    """Sketch of the shingles of two texts together."""
    return thinned(F.array_union(a, b), bits)


def search_tree(value: Column, bounds: list[int], low: int = 0) -> Column:
    """Number of the last bound that is not above ``value``, as a balanced tree of comparisons."""
    if len(bounds) == 1:
        return F.lit(low)
    half = len(bounds) // 2
    return F.when(value < bounds[half], search_tree(value, bounds[:half], low)).otherwise(
        search_tree(value, bounds[half:], low + half))


def ranges(value: Column, bounds: list[int], step: int = 256) -> tuple[Column, Column]:
    """Number of the last of the ascending ``bounds`` that is not above ``value``, and whether it is
    equal: a tree over every ``step``-th bound, then those in between."""
    chunks = [bounds[k : k + step] for k in range(0, len(bounds), step)]
    top = search_tree(value, [c[0] for c in chunks])
    inner = F.element_at(F.from_json(F.lit(json.dumps(chunks)), "array<array<bigint>>"), top + 1)
    at = F.size(F.filter(inner, lambda b: b <= value))
    return top * step + at - 1, F.element_at(inner, at) == value


def fingerprints(docs: DataFrame, words: int = 5, bits: int = 1, rows_per_bucket: int = 1000, most: int = 32_768) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The edited text is the text with its last half (rounded down) replaced by as many first code
    points of the next document, ascending in doc_id, after the last the first.  Documents are cut
    into up to ``most`` ranges of doc_id; the first document of a range is also sent, as a sentinel,
    to the range before it, so that one shuffle brings every document next to the one that follows.

    Null texts are empty.  A null doc_id sorts first.  Rows that repeat a doc_id are ordered by
    their text and each is followed by the next row.  A long text is read whole.  An empty table gives no rows, a table of one
    row follows itself; other columns are not read.
    """
    least = -(2**63)
    rows = docs.select(F.coalesce(resolved("doc_id").cast("long"), F.lit(least)).alias("id"), F.coalesce(resolved("text"), F.lit("")).alias("text"))
    n, first = rows.agg(F.count("*"), F.min("id")).first()
    bounds = [first or 0]
    if (many := min(most, n // rows_per_bucket)) > 1:
        cuts = rows.agg(F.percentile_approx("id", [k / many for k in range(1, many)], max(10_000, 4 * many))).first()[0]
        bounds = sorted({first, *cuts})  # at most ``most`` numbers, ids that exist
    bucket, starts = ranges(F.col("id"), bounds)
    # every row of a first id goes along as a sentinel; the least text of them is met first
    own = F.struct(bucket.alias("b"), F.lit(0).alias("m"))
    ahead = F.struct(F.pmod(bucket - 1, F.lit(len(bounds))).alias("b"), F.lit(1).alias("m"))
    sent = rows.withColumn("x", F.explode(F.when(starts, F.array(own, ahead)).otherwise(F.array(own)))).select(
        F.col("x.b").alias("bucket"), F.col("x.m").alias("mark"), "id", "text")
    order = Window.partitionBy("bucket").orderBy("mark", "id", "text")
    # sketches are made after the shuffle, which moves the texts alone
    dealt = sent.repartition("bucket").sortWithinPartitions("bucket", "mark", "id", "text").withColumn("sketch", sketch(F.col("text"), words, bits))
    paired = dealt.withColumns({"next": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)}).where("mark = 0")
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.col("text").substr(F.lit(1), F.length("text") - half), F.col("next").substr(F.lit(1), half))
    done = paired.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited"), words, bits))
    return done.select(
        F.when(F.col("id") == least, None).otherwise(F.col("id")).alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"), as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))
