"""Operator 11: ranked lexical search over document shards.

``build_index`` turns slices of the documents into shards: a vocabulary and its postings in CSR form
(documents and occurrences of each term), written to the shared folder.  ``search`` counts what the
formula needs of the whole corpus (documents, terms, documents of each asked term) from the shards
alone, and sends the questions to them in waves of bounded size.  A shard first turns the postings
of all asked terms into integer impacts, once; a question then adds the impacts of its terms into a
dense array over the shard's documents, one term at a time.  The best k of a shard are cut by
``argpartition`` with every tie of the k-th kept, ties go to the smaller doc_id, a task merges what
its shards give and Spark merges the tasks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_groups, lean, materialize, small_batches

#: bytes that belong to terms: digits, letters, and all of any character beyond ASCII
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

INDEX = ("ids array<long>, lengths binary, terms array<string>, df array<int>, docs binary, doc_bytes int, tfs binary, tf_bytes int, "
         "n_docs long, n_terms long")


def terms_of(texts) -> tuple:
    """Terms (Arrow strings, A-Z lower-cased) of an Arrow array of texts without nulls, in order, and the
    number of each one's text."""
    import pyarrow as pa

    texts = texts.cast(pa.large_string())
    if not len(texts):
        return texts, np.zeros(0, dtype=np.int64)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    inside = _IN_TERM[data]
    fresh = inside.copy()
    fresh[1:] &= ~inside[:-1]
    first = bounds[:-1][bounds[:-1] < len(data)]
    fresh[first] = inside[first]  # a term does not run from one text into the next
    begin = np.flatnonzero(fresh)
    offsets = np.empty(len(begin) + 1, dtype=np.int64)
    offsets[-1] = inside.sum()
    offsets[:-1] = (np.cumsum(inside) - 1)[begin]
    found = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(offsets), pa.py_buffer(_LOWER[data[inside]]))
    return found, np.searchsorted(bounds, begin, side="right") - 1


def _packed(values: np.ndarray) -> tuple[bytes, int]:
    """Unsigned integers in the narrowest of 1, 2, 4 and 8 bytes, and that width."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return values.astype(kind).tobytes(), kind.itemsize


def _unpacked(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, dtype=f"<u{width}").astype(np.int64)


def build_index(docs: DataFrame, shard_bytes: int = 8 << 20) -> DataFrame:
    """Shards of ``docs`` (doc_id, text), each of about ``shard_bytes`` of text, written to the shared folder.

    Every row is a document of its own: rows that repeat a doc_id, or a doc_id and its text, stay.
    A null text and one without a term hold no postings and count for nothing; a null doc_id stays null;
    a text longer than a shard is a shard alone; other columns are not read; an empty table gives no shards.
    """
    small_batches(docs.sparkSession)

    @lean
    def build(batches):
        import pyarrow as pa

        def shard(group):
            table = pa.Table.from_batches(group).combine_chunks()
            ids, texts = table.column(0).combine_chunks(), table.column(1).combine_chunks()
            found, doc = terms_of(texts)
            n = len(ids)
            coded = found.dictionary_encode()
            place, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + doc, return_counts=True)
            lengths = np.bincount(doc, minlength=n)
            at, docs_wide = _packed(place % n)
            times, tf_wide = _packed(tf)
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.to_pylist()], pa.list_(pa.int64())), pa.array([lengths.astype("<u4").tobytes()]),
                 pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary.cast(pa.string())),
                 pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()),
                                          pa.array(np.bincount(place // n, minlength=len(coded.dictionary)).astype(np.int32))),
                 pa.array([at]), pa.array([docs_wide], pa.int32()), pa.array([times]), pa.array([tf_wide], pa.int32()),
                 pa.array([int((lengths > 0).sum())]), pa.array([len(doc)], pa.int64())],
                names=[c.split()[0] for c in INDEX.split(", ")])

        group, size = [], 0
        for part in (g for b in batches for g in byte_groups(b, limit=shard_bytes)):
            group.append(part)
            size += part.nbytes
            if size >= shard_bytes:
                yield shard(group)
                group, size = [], 0
        if group:
            yield shard(group)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return materialize(texts.mapInArrow(build, INDEX), "lexical-index")


class Best:
    """The k best (score, doc_id) of one question; a null doc_id comes after all others."""

    def __init__(self, k: int):
        self.k, self.score = k, np.zeros(0, dtype=np.int64)
        self.ident, self.none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)

    def add(self, score: np.ndarray, ident: np.ndarray, none: np.ndarray) -> None:
        least = max(1, self.score[-1]) if len(self.score) == self.k else 1
        at = np.flatnonzero(score >= least)
        if len(at) > self.k:
            kth = score[at[np.argpartition(-score[at], self.k - 1)[self.k - 1]]]
            at = at[score[at] >= kth]
        score, ident, none = (np.concatenate(x) for x in ((self.score, score[at]), (self.ident, ident[at]), (self.none, none[at])))
        order = np.lexsort((ident, none, -score))[: self.k]
        self.score, self.ident, self.none = score[order], ident[order], none[order]


def search(index: DataFrame, items: DataFrame, k: int = 20, wave_terms: int = 1 << 17) -> DataFrame:
    """item_id, rank, doc_id, score of the ``k`` best documents with a score above 0 for every row of
    ``items`` (item_id, text).

    Equal scores go by doc_id, null last; rows of the index that agree in both have ranks of their own.
    Rows of ``items`` that repeat item_id and text are one question; other texts under one item_id are
    questions of their own, each with ranks from 1.  A null or empty text, and terms that no document
    holds, give no rows; so do empty tables.  Questions are sent in waves of about ``wave_terms``
    different terms, which bounds what is broadcast; every wave reads all shards.
    """
    spark = index.sparkSession

    @lean
    def words(batches):
        import pyarrow as pa

        for batch in batches:
            found, item = terms_of(batch.column(2))
            coded = found.dictionary_encode()
            size = max(1, len(coded.dictionary))
            place, times = np.unique(item * size + coded.indices.to_numpy(), return_counts=True)
            row = pa.array(place // size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), coded.dictionary.cast(pa.string()).take(pa.array(place % size)), pa.array(times)],
                names=["question", "item_id", "term", "times"])

    asked = items.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    asked = asked.select(F.xxhash64("item_id", "text").alias("question"), "item_id", "text")
    asked = materialize(asked.mapInArrow(words, "question long, item_id long, term string, times long"), "asked")
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("l")).first()
    if not total["l"] or asked.isEmpty():
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    n, length = total["n"], total["l"]

    held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("t")).select(F.col("t.terms").alias("term"), F.col("t.df").alias("df"))
    held = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(float(2 * n + 2)) / (2 * F.col("df") + 1))).cast("long")
    weighed = asked.join(held.select("term", weight.alias("weight")), "term").where("weight > 0")
    waves = -(-asked.count() // wave_terms)
    weighed = materialize(weighed.withColumn("wave", F.pmod("question", F.lit(waves)).cast("int")), "weighed")

    def score(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        best: dict[tuple, Best] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                questions = row["questions"].values
                wanted = questions.field("terms")
                first = wanted.offsets.to_numpy()
                flat = wanted.flatten()
                first = first - first[0]
                coded = flat.field("term").dictionary_encode()
                which, times = coded.indices.to_numpy(), flat.field("times").to_numpy()
                w = np.zeros(len(coded.dictionary), dtype=np.int64)
                w[which] = flat.field("weight").to_numpy()
                place = pc.index_in(coded.dictionary, value_set=row["terms"].values)
                there = place.is_valid().to_numpy(zero_copy_only=False)
                place = place.fill_null(0).to_numpy()
                # postings of the asked terms, and their impacts
                bounds = np.concatenate([[0], np.cumsum(row["df"].values.to_numpy().astype(np.int64))])
                size = np.where(there, bounds[place + 1] - bounds[place], 0) if len(bounds) > 1 else np.zeros(len(w), dtype=np.int64)
                ends = np.cumsum(size)
                if not len(ends) or not ends[-1]:
                    continue
                at = np.repeat(bounds[place] - (ends - size), size) + np.arange(ends[-1])
                doc = _unpacked(row["docs"].as_py(), row["doc_bytes"].as_py())[at]
                tf = _unpacked(row["tfs"].as_py(), row["tf_bytes"].as_py())[at]
                terms = _unpacked(row["lengths"].as_py(), 4)
                if int(terms.max()) * n * 25 >= 2**63:
                    terms = terms.astype(object)
                m = (75 + (25 * terms * n) // length).astype(np.int64)
                impact = np.repeat(w, size) * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
                ids = row["ids"].values
                none = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                begin = ends - size
                names = zip(questions.field("question").to_pylist(), questions.field("item_id").to_pylist(), strict=True)
                for q, name in enumerate(names):
                    total = np.zeros(len(ids), dtype=np.int64)
                    for t in range(first[q], first[q + 1]):
                        here = slice(begin[which[t]], ends[which[t]])
                        total[doc[here]] += times[t] * impact[here]  # a term holds a document once
                    best.setdefault(name, Best(k)).add(total, ids, none)
        for (question, item), top in best.items():
            many = len(top.score)
            yield pa.RecordBatch.from_arrays(
                [pa.array([question] * many, pa.int64()), pa.array([item] * many, pa.int64()), pa.array(top.ident, mask=top.none), pa.array(top.score)],
                names=["question", "item_id", "doc_id", "score"])

    parts = []
    for wave in range(waves):
        each = weighed.where(F.col("wave") == wave).groupBy("question", "item_id").agg(F.collect_list(F.struct("term", "times", "weight")).alias("terms"))
        # one row, bounded by the size of a wave
        one = each.agg(F.collect_list(F.struct("question", "item_id", "terms")).alias("questions"))
        parts.append(index.crossJoin(F.broadcast(one)).mapInArrow(lean(score), "question long, item_id long, doc_id long, score long"))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    by = Window.partitionBy("question", "item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
