"""Array expressions: token similarity, near-duplicate merging, chunks and samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import issue_tokens


def jaccard(a: Column, b: Column) -> Column:
    """Of two token arrays; nothing is similar to an empty one."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(both / F.size(F.array_union(a, b)))


def merge_near_duplicates(items: Column, threshold: float = 0.45) -> Column:
    """Keep an item unless its tokens are at least ``threshold`` similar to a kept one before it."""
    rows = F.transform(items, lambda x: F.struct(x.alias("text"), issue_tokens(x).alias("tokens")))
    none = F.array().cast("array<struct<text:string,tokens:array<string>>>")
    kept = F.aggregate(rows, none, lambda acc, x: F.when(
        F.exists(acc, lambda k: jaccard(x["tokens"], k["tokens"]) >= threshold), acc).otherwise(F.concat(acc, F.array(x))))
    return F.transform(kept, lambda k: k["text"])


def chunk(items: Column, size: int) -> Column:
    n = F.ceil(F.size(items) / size).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(items, i * size + 1, F.lit(size)))).otherwise(
        F.array().cast("array<array<string>>"))


def prompt_sample(items: Column, count: int = 12, letters: int = 200) -> Column:
    return F.transform(F.slice(items, 1, count), lambda x: F.substring(x, 1, letters))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: Column) -> Column:
    """``a`` at length 1; a vector of length zero has no direction and gets nulls."""
    n = F.nullif(norm(a), F.lit(0.0))
    # an array of one, so that the norm is not taken again for every component
    return F.element_at(F.transform(F.array(n), lambda m: F.transform(a, lambda x: x.cast("double") / m)), 1)


def softmax(a: Column) -> Column:
    """Probabilities of scores; the largest is taken off first, so none overflows."""
    e = F.transform(F.array(F.array_max(a)), lambda m: F.transform(a, lambda x: F.exp(x.cast("double") - m.cast("double"))))
    return F.element_at(F.transform(e, lambda v: F.transform(v, lambda x: x / F.aggregate(v, F.lit(0.0), lambda s, y: s + y))), 1)


def top_label(a: Column, labels: list[str]) -> Column:
    """struct<label, score>: the likeliest label, the first among equals, and its probability."""
    p = softmax(a)
    return F.struct(F.element_at(F.array(*map(F.lit, labels)), F.array_position(a, F.array_max(a)).cast("int")).alias("label"), F.array_max(p).alias("score"))
