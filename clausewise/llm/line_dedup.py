"""Operator 8: repeated runs of lines found by winnowing and deleted where they come later.

A text is a sequence of logical lines (physical lines, cut further at sentence ends).  A gram is
the shortest run of lines from a position that holds at least ``gram`` words, hashed.  Winnowing
keeps, in every window of grams whose starts span ``run - gram`` words, the least hash; a run of
``run`` words that two texts share holds such a window whole, so both keep the same gram of it: no
shared run of that length goes unseen.  Positions of kept grams are joined on the hash, and those
that stand in two places or more are extended both ways, line by line, in every way that just
reaches ``run`` words.  Each extended run is a key of its own and meets its own first place; where
it comes later it is deleted.  A longer run is the union of such runs, so it goes whole, whatever
other texts share parts of it.  First is by (doc_id, row, position): the earliest copy of every run
stays.  No two texts are ever compared, so a line or passage that very many texts share costs one
row for each place.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, free_names, give_back, lean, materialize, resolved, small_batches, worker_for

#: where a logical line ends: after a line break, or blanks after the end of a sentence
_END = re.compile(r"[.!?…][^\S\n]+\n?|\n")


def lines(text: str) -> list[str]:
    """Logical lines; joined they are the text."""
    out, at = [], 0
    for m in _END.finditer(text):
        end = m.end()
        out.append(text[at:end])
        at = end
    if at < len(text):
        out.append(text[at:])
    return out


def line_hashes(parts: list[str]) -> tuple[list[int], list[int]]:
    """Hash of each line, white space at the ends and runs of it not counting, and its words."""
    from xxhash import xxh64_intdigest as h

    words = [p.split() for p in parts]
    return [h(" ".join(w)) for w in words], list(map(len, words))


def text_hashes(text: str) -> tuple[list[int], list[int]]:
    """``line_hashes`` of the lines of ``text``, faster where its white space is plain."""
    if "  " in text or "\n " in text or " \n" in text or not text.replace("\n", "").isprintable():
        return line_hashes(lines(text))
    from xxhash import xxh64_intdigest as h

    parts = [p.strip() for p in lines(text)]
    return [h(p) for p in parts], [p.count(" ") + 1 if p else 0 for p in parts]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def winnow(hashes: np.ndarray, words: np.ndarray, text: np.ndarray, run: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, gram hashes) that are kept, of the lines of several texts one after another;
    ``text`` is the number of each line's text.  Lines without words belong to no gram's ends."""
    live = np.flatnonzero(words)
    n = len(live)
    if not n:
        return live, hashes[:0]
    total = np.concatenate([[0], np.cumsum(words[live])])
    end = np.searchsorted(total, total[:-1] + gram)  # gram i holds live lines i .. end[i]-1
    stop = np.searchsorted(text[live], text[live], side="right")  # where the text of line i ends
    whole = np.flatnonzero(end <= stop)
    if not len(whole):
        return live[:0], hashes[:0]
    # polynomial hash of a run by prefix sums; odd multiplier and its inverse modulo 2^64
    with np.errstate(over="ignore"):
        base = np.uint64(0x9E3779B97F4A7C15)
        power = np.cumprod(np.full(n + 1, base, dtype=np.uint64))
        inverse = np.cumprod(np.full(n + 1, np.uint64(pow(int(base), -1, 1 << 64)), dtype=np.uint64))
        prefix = np.concatenate([[np.uint64(0)], np.cumsum(_mix(hashes[live]) * power[:n])])
        g = _mix((prefix[end[whole]] - prefix[whole]) * inverse[whole] + (end[whole] - whole).astype(np.uint64))
    # the window from gram i: grams of the text starting within the next run - gram words
    of = text[live[whole]]
    last = np.minimum(np.searchsorted(total[whole], total[whole] + (run - gram), side="right"), np.searchsorted(of, of, side="right"))
    size = last - np.arange(len(whole))
    # least of each window, the first among equals, from the least of ranges of 1, 2, 4, ... grams
    least, best, width = np.arange(len(whole)), np.arange(len(whole)), 1
    while True:
        now = np.flatnonzero((size >= width) & (size < 2 * width))
        a, b = least[now], least[last[now] - width]
        best[now] = np.where(g[b] < g[a], b, a)
        if 2 * width > size.max():
            break
        a, b = least[: len(least) - width], least[width:]
        least = np.where(g[b] < g[a], b, a)
        width *= 2
    keep = np.zeros(len(whole), dtype=bool)
    keep[best] = True
    return live[whole[keep]], g[keep]


def whole_runs(words: np.ndarray, at: np.ndarray, run: int, gram: int) -> list[tuple[int, int]]:
    """Ranges of lines that hold a gram from one of ``at`` and at least ``run`` words, and no fewer
    lines from their start or to their end would; they begin and end in lines with words."""
    live = np.flatnonzero(words)
    n = len(live)
    total = np.concatenate([[0], np.cumsum(words[live])])
    end = np.searchsorted(total, total[:-1] + run)
    start = np.searchsorted(total, total[1:] - run, side="right") - 1
    a, b = np.concatenate([np.flatnonzero(end <= n), start[start >= 0]]), np.concatenate([end[end <= n], np.flatnonzero(start >= 0) + 1])
    pairs = np.unique(a << 32 | b)
    a, b = pairs >> 32, pairs & 0xFFFFFFFF
    marks = np.searchsorted(live, np.sort(at))
    stop = np.append(np.searchsorted(total, total[marks] + gram), n + 1)  # where the grams end
    holds = stop[np.searchsorted(marks, a)] <= b
    return list(zip(live[a[holds]].tolist(), (live[b[holds] - 1] + 1).tolist(), strict=True))


def repeated_runs(docs: DataFrame, run: int = 50, gram: int = 25) -> DataFrame:
    """(doc_id, row, words, spans) for each text of ``docs`` (doc_id, row, text; no nulls): its words
    and the ranges of logical lines to delete."""
    small_batches(docs.sparkSession)

    @lean
    def sketch(batches):
        import pyarrow as pa

        worker_for("lines")
        for batch in (g for b in batches for g in byte_groups(b, 2)):
            found = [text_hashes(t) for t in batch.column(2).to_pylist()]
            many = np.fromiter((len(h) for h, _ in found), dtype=np.int64, count=len(found))
            h = np.fromiter((x for hs, _ in found for x in hs), dtype=np.uint64, count=int(many.sum()))
            w = np.fromiter((x for _, ws in found for x in ws), dtype=np.int64, count=int(many.sum()))
            text, ends = np.repeat(np.arange(len(found)), many), np.concatenate([[0], np.cumsum(many)])
            at, g = winnow(h, w, text, run, gram)
            bounds = pa.array(np.searchsorted(at, ends).astype(np.int32))
            has = np.diff(np.searchsorted(at, ends)) > 0  # texts without a gram need no lines
            keep = np.repeat(has, many)
            size = np.concatenate([[0], np.cumsum(np.where(has, many, 0))]).astype(np.int32)
            pack = [pa.Array.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(np.ascontiguousarray(size * x.itemsize)), pa.py_buffer(np.ascontiguousarray(x[keep]))])
                    for x in (h, w.astype(np.int32))]
            total = np.bincount(text, weights=w, minlength=len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(total), *pack,
                 pa.ListArray.from_arrays(bounds, pa.array((at - ends[text[at]]).astype(np.int32))), pa.ListArray.from_arrays(bounds, pa.array(g.view(np.int64)))],
                names=["doc_id", "row", "total", "lines", "words", "at", "gram"])

    sketches = materialize(
        docs.select("doc_id", "row", "text").mapInArrow(
            sketch, "doc_id long, row long, total long, lines binary, words binary, at array<int>, gram array<long>")
        .withColumn("n", F.monotonically_increasing_id()), "lines")  # written, so the numbers stay
    grams = sketches.select("n", F.explode(F.arrays_zip("at", "gram")).alias("x")).select("x.gram", "n", "x.at")
    # tables of their own, so that a join can split the rows of a hot key
    repeated = materialize(grams.groupBy("gram").agg(F.count("*").alias("places")).where("places > 1").select("gram"), "repeated")
    marks = grams.join(repeated, "gram", "left_semi").groupBy("n").agg(F.collect_list("at").alias("marks"))  # within a text
    marked = sketches.where("size(at) > 0").select("n", "doc_id", "row", "lines", "words").join(marks, "n")

    @lean
    def cover(batches):
        import pyarrow as pa
        from xxhash import xxh64_intdigest as hashed

        for batch in (b.slice(a, 500) for b in batches for a in range(0, b.num_rows, 500)):
            out: list[list] = [[], [], [], [], []]
            for x in batch.to_pylist():
                words = np.frombuffer(x["words"], np.int32).astype(np.int64)
                for a, b in whole_runs(words, np.array(x["marks"]), run, gram):
                    key = hashed(x["lines"][8 * a : 8 * b])
                    for col, v in zip(out, (key - (key >> 63 << 64), x["doc_id"], x["row"], a, b), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, (pa.int64(),) * 3 + (pa.int32(),) * 2, strict=True)], names=["key", "doc_id", "row", "a", "b"])

    runs = materialize(marked.select("doc_id", "row", "lines", "words", "marks").mapInArrow(
        cover, "key long, doc_id long, row long, a int, b int"), "runs")
    firsts = materialize(runs.groupBy("key").agg(F.min(F.struct("doc_id", "row", "a", "b")).alias("first"), F.count("*").alias("places")).where(
        "places > 1").select("key", "first"), "firsts")
    later = runs.join(firsts, "key").where(
        "(doc_id, row) > (first.doc_id, first.row) or doc_id = first.doc_id and row = first.row and a >= first.b")
    none = F.lit(None).cast("struct<a:int,b:int>")
    both = sketches.select("doc_id", "row", "total", none.alias("span")).unionByName(
        later.select("doc_id", "row", F.lit(None).cast("long").alias("total"), F.struct("a", "b").alias("span")))
    return both.groupBy("doc_id", "row").agg(F.max("total").alias("words"), F.collect_set("span").alias("spans"))  # once for rows that repeat


def delete_lines(text: str, spans: list[tuple[int, int]], run: int) -> tuple[str, int, int]:
    """Text without the runs of at least ``run`` words; lines deleted; runs deleted."""
    parts = lines(text)
    words = np.concatenate([[0], np.cumsum([len(p.split()) for p in parts])]).astype(int)
    gone = np.zeros(len(parts), dtype=bool)
    for a, b in spans:
        if words[b] - words[a] >= run:
            gone[a:b] = True
    kept = "".join(p for p, g in zip(parts, gone, strict=True) if not g)
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()) if len(gone) else 0
    return kept, int(gone.sum()), runs


def dedup_lines(docs: DataFrame, run: int = 50, gram: int = 25,
                names: tuple[str, str, str] = ("lines_deleted", "runs_deleted", "words_left")) -> DataFrame:
    """``docs`` with later repeats of runs of at least ``run`` words deleted from ``text``.

    All rows and columns stay, and the columns ``names`` come to them (columns of these names are
    replaced): lines deleted, runs deleted and words left.  Null texts stay null and hold no lines.  A row is
    known by doc_id and the hash of its text: rows that repeat both are one text and are treated
    alike; ids that repeat with other texts are texts of their own.  A null doc_id sorts first.
    A long text is read whole.  An empty table gives no rows.
    """
    key, row, spans, words, new = free_names(docs, "__id", "__row", "__spans", "__words", "__new")
    text = resolved("text")
    keyed = docs.withColumns({
        key: F.coalesce(resolved("doc_id").cast("long"), F.lit(-(2**63))), row: F.xxhash64(F.coalesce(text, F.lit("")))})
    found = repeated_runs(keyed.where("text is not null and text <> ''").select(F.col(key).alias("doc_id"), F.col(row).alias("row"), "text"), run, gram)
    joined = keyed.join(
        found.select(F.col("doc_id").alias(key), F.col("row").alias(row), F.col("spans").alias(spans), F.col("words").alias(words)),
        [key, row], "left")

    @F.pandas_udf("text string, lines long, runs long, words long")
    def apply(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, s in zip(text, spans, strict=True):
            if t is None:
                rows.append((None, 0, 0, 0))
            else:
                kept, n, r = delete_lines(t, [(x["a"], x["b"]) for x in s], run)
                rows.append((kept, n, r, len(kept.split())))
        give_back()
        return pd.DataFrame(rows, columns=["text", "lines", "runs", "words"])

    # only texts that lose something go to Python
    hit = F.coalesce(F.size(spans) > 0, F.lit(False))
    done = joined.withColumn(new, apply(F.when(hit, text), F.when(hit, F.col(spans))))
    replaced = {"text": F.when(hit, F.col(new)["text"]).otherwise(text), names[0]: F.col(new)["lines"], names[1]: F.col(new)["runs"],
                names[2]: F.when(hit, F.col(new)["words"]).otherwise(F.coalesce(words, F.lit(0)))}
    return done.withColumns(replaced).drop(key, row, spans, words, new)
