"""Writers; a single file only where it is asked for."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import small_batches
from .steps import in_steps


def csv(df: DataFrame, path: str, single: bool = False) -> None:
    """CSV with a header; lines end in a carriage return and a line feed."""
    (df.coalesce(1) if single else df).write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', lineSep="\r\n", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def replace_csv(df: DataFrame, path: str) -> None:
    """Put ``df``, which may read ``path`` itself, in the place of ``path``: it is written beside it
    and takes its name when it is whole."""
    spark = df.sparkSession
    new, old = f"{path}.{uuid.uuid4().hex}", f"{path}.{uuid.uuid4().hex}.old"
    csv(df, new)
    paths = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, new, old)]
    fs = paths[0].getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(paths[0]):
        fs.rename(paths[0], paths[2])
    fs.rename(paths[1], paths[0])
    fs.delete(paths[2], True)


def jsonl(df: DataFrame, path: str, single: bool = False, by: str | None = None) -> None:
    """JSON lines with explicit nulls; ``by`` gives a folder to each value (one per sentiment)."""
    w = (df.coalesce(1) if single else df).write.mode("overwrite").option("ignoreNullFields", "false")
    (w.partitionBy(by) if by else w).json(path)


def json_arrays(df: DataFrame, path: str, *order: str) -> None:
    """The rows as JSON objects in arrays, a file each, that follow one another in ``order``; rows pass through
    their task one after another, so an array may be of any size.  No rows give no file with an array."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def arrays(batches):
        opened = False
        for batch in (b for b in batches if b.num_rows):
            marks = pa.array(["," if opened else "[", *[","] * (batch.num_rows - 1)])
            opened = True
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(marks, batch.column(0), "")], names=["value"])
        if opened:
            yield pa.RecordBatch.from_pydict({"value": ["]"]})

    small_batches(df.sparkSession)
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).select(F.to_json(F.struct(*df.columns)).alias("value"))
    rows.mapInArrow(arrays, "value string").write.mode("overwrite").text(path)


def sentiment_files(nested: DataFrame, path: str) -> None:
    """Reviews with their clauses (``reviews.nest_by_review``), one folder a sentiment."""
    jsonl(nested.select("sentiment", F.nullif("review_key", F.lit("")).alias("review_id"), "place_name", "clauses"), path, by="sentiment")


def vector_index(df: DataFrame, path: str) -> None:
    """(position, embedding) as a flat index: unit vectors in single precision, by position."""
    from clausewise.functions.arrays import unit

    flat = df.select("position", unit(F.col("embedding")).cast("array<float>").alias("embedding"))
    flat.repartitionByRange("position").sortWithinPartitions("position").write.mode("overwrite").parquet(path)


def append_cache(df: DataFrame, path: str, every: int | None = None, make=None) -> None:
    """Append-only cache; the newest row of a key wins on reading.  With ``every`` the rows are written
    about so many at a time, so a run that breaks off loses no more than that; ``make`` turns the
    rows of a step into cache rows (costly work, a model's say) and sees every row once.  ``df`` itself is
    computed once."""
    for step in in_steps(df, every, "cache-rows") if every else [df]:
        (make(step) if make else step).withColumn("written", F.current_timestamp()).write.mode("append").parquet(path)


def read_cache(spark, path: str, key: str = "cluster_id") -> DataFrame:
    df = spark.read.parquet(path)
    return df.groupBy(key).agg(F.max_by(F.struct(*[c for c in df.columns if c not in (key, "written")]), "written").alias("r")).select(key, "r.*")


def markdown_sections(df: DataFrame, header: str, body: str, order: str) -> DataFrame:
    """(order, text): '## header', a blank line and the body, a row a section."""
    return df.select(F.col(order).alias("order"), F.concat(F.lit("## "), header, F.lit("\n\n"), body, F.lit("\n")).alias("text"))


def numbered_reviews(df: DataFrame) -> DataFrame:
    """Reviews (seq from 1, text) as sections of a Markdown file."""
    return markdown_sections(df.withColumn("h", F.concat(F.lit("Review "), F.col("seq").cast("string"))), "h", "text", "seq")


def matched_reviews(df: DataFrame) -> DataFrame:
    """Reviews (seq, place, text) under the place that they name."""
    return markdown_sections(df, "place", "text", "seq")


def judged_reviews(df: DataFrame) -> DataFrame:
    """Judgements (seq, location_name, judgement, action): the reason, then the actions."""
    actions = F.when(F.col("action") == "", "").otherwise(F.concat(F.lit("\n\n**Actions:** "), "action"))
    return markdown_sections(df.withColumn("b", F.concat("judgement", actions)), "location_name", "b", "seq")


def markdown(sections: DataFrame, path: str) -> None:
    """Sections in their order, as text files that follow one another; no task holds them all."""
    sections.repartitionByRange("order").sortWithinPartitions("order").select("text").write.mode("overwrite").text(path)


def judgements(df: DataFrame, path: str) -> None:
    csv(df.select("location_name", "judgement", "action"), path)


def progress(path: str, done: int, total: int, **more) -> None:
    """State of a run as a small JSON file, replaced as a whole; the driver's own file."""
    with open(f"{path}.new", "w", encoding="utf-8") as f:
        json.dump({"done": done, "total": total, **more}, f)
    os.replace(f"{path}.new", path)
