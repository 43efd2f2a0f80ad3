"""Near-duplicates of ordered lists of any length, merged in parallel.

A row is kept unless an earlier kept row of its list has token similarity of at least the threshold:
``functions.arrays.merge_near_duplicates`` as a fold over one list, here as joins.  Rows of one token set
are one node (the later ones go whatever becomes of the first).  Similar pairs come from an equi-join on
rare tokens: with the tokens of each row ordered by frequency, two sets that reach the threshold share a
token among the first of both, how many depends on both sizes.  Only hashes, sizes and signatures of a few longs go
through that join; pairs whose signatures differ in too many bits go at once, and every pair that is left is
verified by its whole sets.  The kept rows are then settled in rounds: who has no undecided earlier neighbour is kept, the
neighbours of kept rows go, and the rest is looked at again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausewise.functions.arrays import jaccard, merge_near_duplicates
from clausewise.functions.text import issue_tokens

from .metric import stored

SIGNATURE = 16


def signature(key: Column) -> list[Column]:
    """``SIGNATURE`` longs of a group of hashed tokens, as aggregates: each token flips one bit.  Two signatures differ in
    no more bits than there are tokens that only one of both sets holds."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), key.bitwiseAND(63).cast("int"))
    word = F.pmod(F.shiftright(key, 6), F.lit(SIGNATURE))
    return [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"s{k}") for k in range(SIGNATURE)]


def similar_before(sets: DataFrame, threshold: float) -> DataFrame:
    """(list, a, b): pairs of ``sets`` (list, pos, tokens: distinct, none empty) with a before b and a similarity of
    at least ``threshold``."""
    sets = stored(sets.select("list", "pos", "tokens").withColumn("row", F.monotonically_increasing_id()), "numbered-sets")
    # joins are hinted, since the size of a file says little about the rows that its lists are exploded to
    words = sets.select("row", F.size("tokens").alias("m"), F.explode(F.transform("tokens", lambda t: F.xxhash64("list", t))).alias("key"))
    counts = words.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")  # what one set alone holds comes first in it and meets nothing
    shared = words.hint("merge").join(counts, "key").groupBy("row", "m").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("n", "key"))), lambda x: x["key"]).alias("keys"), *signature(F.col("key")))
    shared = stored(shared.withColumn("q", F.size("keys")), "token-sets")
    # a little is taken off before rounding up, for what doubles round
    prefix = F.col("q") - F.ceil(F.col("m") * threshold - 1e-9).cast("int") + 1
    marks = [f"s{k}" for k in range(SIGNATURE)]
    entries = shared.where(prefix > 0).select("row", "m", "q", *marks, F.posexplode(F.slice("keys", F.lit(1), prefix)).alias("at", "key"))
    a, b = entries.alias("a"), entries.alias("b")
    both = F.ceil((F.col("a.m") + F.col("b.m")) * (threshold / (1 + threshold)) - 1e-9)  # tokens that they must share
    differ = sum((F.bit_count(F.col(f"a.{s}").bitwiseXOR(F.col(f"b.{s}"))) for s in marks), F.lit(0))
    met = a.hint("merge").join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.row") < F.col("b.row"))
                               & (F.col("a.at") <= F.col("a.q") - both) & (F.col("b.at") <= F.col("b.q") - both)
                               & (differ <= F.col("a.q") + F.col("b.q") - 2 * both))
    pairs = met.select(F.col("a.row").alias("row"), F.col("b.row").alias("other")).distinct()
    named = sets.select("row", F.struct("list", "pos", "tokens").alias("x")), sets.select(F.col("row").alias("other"), F.struct("list", "pos", "tokens").alias("y"))
    found = pairs.hint("merge").join(named[0], "row").hint("merge").join(named[1], "other")
    return found.where((F.col("x.list") == F.col("y.list")) & (jaccard(F.col("x.tokens"), F.col("y.tokens")) >= threshold)).select(
        "x.list", F.least("x.pos", "y.pos").alias("a"), F.greatest("x.pos", "y.pos").alias("b"))


def settle(edges: DataFrame) -> DataFrame:
    """(list, pos) of the rows that go: those with an earlier kept neighbour."""
    edges = stored(edges, "similar-before")
    gone = edges.select("list", F.col("b").alias("pos")).limit(0)
    while not edges.isEmpty():
        first = edges.select("list", F.col("a").alias("pos")).distinct().hint("merge").join(edges.select("list", F.col("b").alias("pos")).distinct(), ["list", "pos"], "left_anti")
        first = stored(first, "kept-first")
        out = stored(edges.hint("merge").join(first.withColumnRenamed("pos", "a"), ["list", "a"], "left_semi").select("list", F.col("b").alias("pos")).distinct(), "merged-away")
        gone = gone.unionByName(out)
        done = first.unionByName(out)
        edges = stored(edges.hint("merge").join(done.withColumnRenamed("pos", "a"), ["list", "a"], "left_anti").hint("merge").join(
            out.withColumnRenamed("pos", "b"), ["list", "b"], "left_anti").select("list", "a", "b"), "similar-before")
    return gone


def merge_ordered(rows: DataFrame, threshold: float = 0.45) -> DataFrame:
    """The rows of ``rows`` (list, pos: unique within a list, text) that are kept.  A text without tokens, or null,
    is similar to nothing and stays; other columns are not returned; no rows give none."""
    coded = stored(rows.select("list", "pos", "text", F.array_sort(F.coalesce(issue_tokens(F.col("text")), F.array().cast("array<string>"))).alias("tokens")), "tokens")
    sets = stored(coded.where(F.size("tokens") > 0).groupBy("list", "tokens").agg(F.min("pos").alias("pos")), "distinct-sets")
    kept = sets.select("list", "pos").hint("merge").join(settle(similar_before(sets, threshold)), ["list", "pos"], "left_anti")
    bare = coded.where(F.size("tokens") == 0).select("list", "pos", "text")
    return coded.select("list", "pos", "text").hint("merge").join(kept, ["list", "pos"], "left_semi").unionByName(bare)


def merge_lists(df: DataFrame, key: str, column: str, threshold: float = 0.45, fold_most: int = 500) -> DataFrame:
    """``key`` and ``column`` (a list of texts) without its near-duplicates.  Lists of up to ``fold_most`` texts are
    folded in their row; longer ones are merged together as rows.  Both give the same lists."""
    long = F.size(column) > fold_most
    folded = df.where(~long).select(key, merge_near_duplicates(F.col(column), threshold).alias(column))
    if df.where(long).isEmpty():
        return folded
    rows = df.where(long).select(F.col(key).alias("list"), F.posexplode(column).alias("pos", "text"))
    merged = merge_ordered(rows, threshold).groupBy("list").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]).alias(column))
    return folded.unionByName(merged.withColumnRenamed("list", key))
