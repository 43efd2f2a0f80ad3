"""The first of many keywords that a text contains, by an Aho-Corasick automaton."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = 2**62


def first_of_keywords(df: DataFrame, keywords: DataFrame, text: str = "text", part: int = 200_000) -> DataFrame:
    """``df`` with the column ``keyword``: of ``keywords`` (seq: unique, keyword) the one of the least seq that the text
    contains, in any case; null if none does, or the text is null.  An empty keyword is in every text.

    A task reads a text once, whatever the number of keywords: an automaton of all of them runs over it.
    Keywords go to the tasks in parts of at most ``part``, so what is sent at once is bounded; the least seq
    over the parts counts, and the keyword itself is joined back by its seq.
    """
    import pyarrow as pa

    if not {"__low", "__least"}.isdisjoint(df.columns):
        raise ValueError("the columns __low and __least are taken")
    lowered = keywords.where("keyword is not null").groupBy(F.lower("keyword").alias("word")).agg(F.min("seq").alias("seq"))
    total = lowered.count()
    parts = -(-total // part)
    rows = df.withColumns({"__low": F.lower(text), "__least": F.lit(NONE).cast("long")})
    for n in range(parts):
        some = lowered.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == n).collect()  # about ``part`` keywords
        held = df.sparkSession.sparkContext.broadcast([(r["word"], r["seq"]) for r in some])

        def scan(batches, held=held):
            import ahocorasick

            found, empty = ahocorasick.Automaton(), NONE
            for word, seq in held.value:
                if word:
                    found.add_word(word, seq)
                else:
                    empty = seq
            found.make_automaton()
            some = len(found) > 0
            for batch in batches:
                low, least = batch.column("__low").to_pylist(), batch.column("__least").to_numpy()
                own = [NONE if t is None else min([empty, *(seq for _, seq in found.iter(t))] if some else [empty]) for t in low]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(np.minimum(np.array(own, dtype=np.int64), least))], names=batch.schema.names)

        rows = rows.mapInArrow(scan, rows.schema)
    names = keywords.select(F.col("seq").cast("long").alias("__least"), "keyword")
    return rows.drop("__low").join(names, "__least", "left").drop("__least")
