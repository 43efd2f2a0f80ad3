"""JSON arrays of any size, read by byte ranges.

Whether a byte of JSON lies inside a string, and how deep, depends on all bytes before it.  A first pass
reads every range once and works out what it does to both possible states at its start (each quotation
mark that no backslash escapes flips the state, brackets count where the state is outside); composing a few
numbers a range in order gives the true state at each start.  A second pass then finds the elements that
begin in each range, reads the last one to its end, and hands the texts to ``from_json``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUOTE, SLASH, COMMA = 34, 92, 44


def files_of(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, size) of the files under ``path``, in order; hidden ones do not count."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    listed, found = at.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(at, True), []
    while listed.hasNext():
        s = listed.next()
        if not s.getPath().getName().startswith(("_", ".")):
            found.append((s.getPath().toString(), s.getLen()))
    return sorted(found)


def _open(uri: str):
    from pyarrow import fs

    store, at = fs.FileSystem.from_uri(uri.replace("file:/", "file:///", 1) if uri.startswith("file:/") and not uri.startswith("file://") else uri)
    return store.open_input_file(at)


def _begin(file, at: int, size: int) -> int:
    """The first place from ``at`` on that no backslash stands before."""
    while 0 < at < size and file.read_at(1, at - 1) == b"\\":
        at += 1
    return min(at, size)


def structure(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the quotation marks before each byte (those that are escaped do not count), and +1 or -1 where a
    bracket opens or closes.  No backslash stands before the first byte."""
    slash = data == SLASH
    quote = data == QUOTE
    if slash.any():
        # a mark is escaped after an odd run of backslashes
        last = np.maximum.accumulate(np.where(~slash, np.arange(len(data)), -1))
        run = np.concatenate([[0], (np.arange(len(data)) - last)[:-1]])
        quote &= run % 2 == 0
    parity = (np.cumsum(quote) - quote) & 1
    step = np.isin(data, (91, 123)).astype(np.int8) - np.isin(data, (93, 125)).astype(np.int8)
    return parity.astype(np.int8) + 2 * quote.astype(np.int8), step


def read_json_array(spark: SparkSession, path: str, schema: str, split_bytes: int = 4 << 20) -> DataFrame:
    """The elements of the JSON array in each file under ``path``, as columns of ``schema``, with ``seq``: unique, and
    ascending in the order of files and of places in them.  A task takes some 40 bytes of memory for a byte of a range.  An element that does not fit the schema is a
    row of nulls; an empty file, or an empty array, has none.  The rows do not depend on ``split_bytes``."""
    import pyarrow as pa

    files = files_of(spark, path)
    ranges = [(number, uri, at, min(at + split_bytes, size), size) for number, (uri, size) in enumerate(files) for at in range(0, size, split_bytes)]
    out_schema = "value string, seq long"
    if not ranges:
        return spark.createDataFrame([], out_schema).select(F.from_json("value", schema).alias("r"), "seq").select("r.*", "seq")
    tasks = max(1, min(len(ranges), 4 * spark.sparkContext.defaultParallelism))
    table = spark.createDataFrame(ranges, "file int, uri string, begin long, stop long, size long").repartition(tasks, "file", "begin")

    def bytes_of(row) -> tuple:
        file = _open(row["uri"])
        begin = _begin(file, row["begin"], row["size"])
        stop = _begin(file, row["stop"], row["size"])
        return file, begin, np.frombuffer(file.read_at(max(0, stop - begin), begin), dtype=np.uint8)

    def effect(batches: Iterator):
        for batch in batches:
            for row in batch.to_pylist():
                file, _, data = bytes_of(row)
                file.close()
                state, step = structure(data)
                odd = state & 1
                flips = int((state >= 2).sum()) & 1
                yield pa.RecordBatch.from_pydict({
                    "file": pa.array([row["file"]], pa.int32()), "begin": [row["begin"]], "flips": pa.array([flips], pa.int32()),
                    "outside": [int(step[odd == 0].sum())], "inside": [int(step[odd == 1].sum())]})

    seen = {}
    inside, depth, now = 0, 0, -1
    for r in sorted(table.mapInArrow(effect, "file int, begin long, flips int, outside long, inside long").collect(), key=lambda r: (r["file"], r["begin"])):
        if r["file"] != now:  # a few numbers a range
            inside, depth, now = 0, 0, r["file"]
        seen[r["file"], r["begin"]] = (inside, depth)
        depth += r["inside"] if inside else r["outside"]
        inside ^= r["flips"]
    known = [(f, u, b, s, n, *seen[f, b]) for f, u, b, s, n in ranges]
    states = spark.createDataFrame(known, "file int, uri string, begin long, stop long, size long, inside int, depth long").repartition(tasks, "file", "begin")

    def elements(batches: Iterator):
        for batch in batches:
            for row in batch.to_pylist():
                file, begin, data = bytes_of(row)
                inside, depth = row["inside"], row["depth"]
                cuts, held, at, first = [], [data], begin, True
                while len(data):
                    state, step = structure(data)
                    out = (state & 1) == inside
                    step = np.where(out, step, 0)
                    level = depth + np.cumsum(step)
                    # an element begins behind the array's bracket or a comma at its level, and ends before a comma or the bracket
                    opens = out & (((step == 1) & (level == 1)) | ((data == COMMA) & (level == 1)))
                    closes = out & (step == -1) & (level == 0)
                    own = np.flatnonzero(opens | closes)
                    if not first:
                        own = own[:1]
                    cuts += [(at - begin + int(p), bool(opens[p])) for p in own]
                    depth, inside = int(level[-1]), inside ^ (int((state >= 2).sum()) & 1)
                    at += len(data)
                    if not first and len(own) or not cuts or not cuts[-1][1]:
                        break
                    # the last element goes on behind the range
                    first = False
                    stop = _begin(file, min(at + (1 << 20), row["size"]), row["size"])
                    data = np.frombuffer(file.read_at(max(0, stop - at), at), dtype=np.uint8)
                    held.append(data)
                file.close()
                raw = b"".join(x.tobytes() for x in held)
                found = [(raw[a + 1 : b].strip(), begin + a) for (a, go), (b, _) in zip(cuts, cuts[1:], strict=False) if go]
                found = [(t, p) for t, p in found if t]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([t.decode("utf-8", "replace") for t, _ in found]), pa.array([row["file"] << 44 | p for _, p in found], pa.int64())], names=["value", "seq"])

    return states.mapInArrow(elements, out_schema).select(F.from_json("value", schema).alias("r"), "seq").select("r.*", "seq")
