"""Operator 5: token ids in shard files whose document boundaries are Elias-Fano coded.

File format (little-endian), one file a shard of consecutive documents::

    "CWEF" | u8 version | u8 bytes of an id | u16 0
    ids: u16 or u32 [u]       all ids one after another, zeros up to a multiple of 8 bytes
    keys: i64[n]              the documents' keys, in file order
    upper: u64[...]           unary coded high parts of the n+1 boundaries
    low: u64[...]             low parts, bit-packed
    u64 documents n | u64 ids u | u64 words of upper bits | u64 words of low bits | u64 low bits | "CWEFCWEF"

Boundary i is the number of ids before document i of the shard.  ``select`` over the upper bits
uses the ones before each 64-bit word as its directory (built in memory on opening), so an offset
costs a binary search over words and one look at a word; no 64-bit table of offsets is stored.
The boundaries come after the ids, so a task writes ids as it makes them and a reader takes them
run by run: neither holds a shard.
"""

from __future__ import annotations

import struct
import zlib
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import ByteBpe
from .common import byte_groups, filesystem, fresh_path, lean, materialize, small_batches

_HEAD = struct.Struct("<4sBBH")
_TAIL = struct.Struct("<QQQQQ8s")


class EliasFano:
    """A non-decreasing sequence of n integers below or equal to ``top``, in about
    n * (2 + log2(top / n)) bits."""

    def __init__(self, n: int, low_bits: int, upper: np.ndarray, low: np.ndarray):
        self.n, self.low_bits, self.upper, self.low = n, low_bits, upper, low
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(upper), dtype=np.int64)])

    @classmethod
    def encode(cls, values: np.ndarray, top: int) -> "EliasFano":
        values = np.asarray(values, dtype=np.uint64)
        n = len(values)
        low_bits = max(0, (max(top, 1) // max(n, 1)).bit_length() - 1)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros(-(-(int(at[-1]) + 1 if n else 1) // 64) * 64, dtype=np.uint8)
        bits[at] = 1
        upper = np.packbits(bits, bitorder="little").view("<u8")
        if low_bits:
            part = ((values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
            low = np.packbits(np.pad(part, (0, -len(part) % 64)), bitorder="little").view("<u8")
        else:
            low = np.zeros(0, dtype="<u8")
        return cls(n, low_bits, upper, low)

    def select(self, i: int) -> int:
        """Value number ``i``."""
        word = int(np.searchsorted(self.ones, i, side="right")) - 1
        rest, bits = i - int(self.ones[word]), int(self.upper[word])
        for _ in range(rest):
            bits &= bits - 1
        high = word * 64 + (bits & -bits).bit_length() - 1 - i
        return high << self.low_bits | self._low(i)

    def _low(self, i: int) -> int:
        if not self.low_bits:
            return 0
        at, shift = divmod(i * self.low_bits, 64)
        got = int(self.low[at]) >> shift
        if shift + self.low_bits > 64:
            got |= int(self.low[at + 1]) << (64 - shift)
        return got & ((1 << self.low_bits) - 1)


class ShardWriter:
    """Writes a file of the format above to ``out``, some documents at a time."""

    def __init__(self, out, wide: bool):
        self.out, self.kind = out, np.dtype("<u4" if wide else "<u2")
        self.keys: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []
        out.write(_HEAD.pack(b"CWEF", 2, self.kind.itemsize, 0))

    def add(self, keys: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.out.write(ids.astype(self.kind).tobytes())
        self.keys.append(np.asarray(keys, dtype="<i8"))
        self.lengths.append(np.asarray(lengths, dtype=np.int64))

    def close(self) -> tuple[int, int]:
        """Documents and ids of the file."""
        ends = np.concatenate([[0], np.cumsum(np.concatenate([np.zeros(0, dtype=np.int64), *self.lengths]))])
        n, total = len(ends) - 1, int(ends[-1])
        ef = EliasFano.encode(ends, total)
        self.out.write(bytes(-total * self.kind.itemsize % 8))
        for part in (*self.keys, ef.upper, ef.low):
            self.out.write(part.tobytes())
        self.out.write(_TAIL.pack(n, total, len(ef.upper), len(ef.low), ef.low_bits, b"CWEFCWEF"))
        return n, total


class Shard:
    """A file of the format above, opened for reading at any place."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        magic, version, width, _ = _HEAD.unpack(file.read_at(_HEAD.size, 0))
        n, total, words, lows, low_bits, end = _TAIL.unpack(file.read_at(_TAIL.size, size - _TAIL.size))
        if magic != b"CWEF" or end != b"CWEFCWEF" or version != 2:
            raise ValueError("not a token file")
        self.kind = np.dtype(f"<u{width}")
        at = size - _TAIL.size - 8 * (n + words + lows)
        raw = file.read_at(8 * (n + words + lows), at)
        self.keys = np.frombuffer(raw, "<i8", n)
        self.ends = EliasFano(n + 1, low_bits, np.frombuffer(raw, "<u8", words, 8 * n), np.frombuffer(raw, "<u8", lows, 8 * (n + words)))

    def __len__(self) -> int:
        return len(self.keys)

    def ids(self, start: int, stop: int) -> np.ndarray:
        width = self.kind.itemsize
        return np.frombuffer(self.file.read_at(width * (stop - start), _HEAD.size + width * start), self.kind)

    def document(self, i: int) -> tuple[int, np.ndarray]:
        start = self.ends.select(i)
        return start, self.ids(start, self.ends.select(i + 1))

    def runs(self, limit: int = 1 << 20):
        """(number of the first document, bounds of each, ids) of runs of about ``limit`` ids."""
        i, start = 0, 0
        while i < len(self):
            bounds = [start]
            while i + len(bounds) <= len(self) and (len(bounds) == 1 or bounds[-1] - start < limit):
                bounds.append(self.ends.select(i + len(bounds)))
            yield i, bounds, self.ids(start, bounds[-1])
            i, start = i + len(bounds) - 1, bounds[-1]


def write_token_files(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None,
                      shards: int | None = None, shard_bytes: int = 128 << 20) -> DataFrame:
    """Encode ``docs`` (doc_id, text) and write the shard files, ascending in doc_id.

    Returns the manifest: shard, path, n_docs, n_tokens, first (ids before the shard).
    A null text counts as empty and holds the end id alone; a null doc_id sorts first and is
    stored as the least 64-bit integer (which is read back as null); rows that repeat a doc_id stay, as
    rows of their own, in an order that their texts give, and may lie in several shards, so a hot id makes no
    large one; a long text is encoded whole; an empty table gives no files and an empty manifest.  Other columns are not read.
    ``shards``: by default a shard holds about ``shard_bytes`` of text.  Every attempt of a task
    writes a file of its own name and the manifest names the one that counts, so a task that runs
    again after a lost executor leaves at most a file that nobody reads.
    """
    spark = docs.sparkSession
    root = path or fresh_path(spark, "tokens")
    small_batches(spark)
    if not shards:
        size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // shard_bytes))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    ranged = (
        docs.select(key.alias("key"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text")).repartitionByRange(shards, "key", "tie").sortWithinPartitions("key", "tie", "text").drop("tie")
    )

    @lean
    def write(batches):
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        encoder = ByteBpe.load(tokenizer)
        wide = encoder.tokenizer.get_vocab_size() > 65536 or end_id > 65535
        shard = TaskContext.get().partitionId()
        groups = (g for b in batches for g in byte_groups(b, limit=2_000_000))
        first = next(groups, None)
        if first is None:
            return
        fs, at = filesystem(root)
        fs.create_dir(at, recursive=True)
        name = f"shard-{shard:08d}-{uuid.uuid4().hex}.cwef"
        with fs.open_output_stream(f"{at}/{name}") as out:
            writer = ShardWriter(out, wide)
            for batch in chain([first], groups):
                ids, bounds = encoder.encode(batch.column(1))
                writer.add(batch.column(0).to_numpy(), np.insert(ids, bounds[1:], end_id), np.diff(bounds) + 1)
            n, total = writer.close()
        yield pa.RecordBatch.from_pydict({"shard": [shard], "path": [f"{root}/{name}"], "n_docs": [n], "n_tokens": [total]})

    manifest = materialize(
        ranged.mapInArrow(write, "shard long, path string, n_docs long, n_tokens long"), "token-manifest"
    )
    # a few numbers a shard; the running sum is over shards, never over documents
    from pyspark.sql import Window

    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) read back from the files of a manifest.

    ``ids`` holds the document's ids as little-endian unsigned 32-bit bytes.
    """
    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    @lean
    def read(batches):
        import pyarrow as pa

        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                fs, at = filesystem(path)
                with fs.open_input_file(at) as f:
                    shard = Shard(f)
                    for i, bounds, ids in shard.runs():
                        raw = memoryview(ids.astype("<u4")).cast("B")
                        at = (np.array(bounds) - bounds[0]).tolist()
                        each = [raw[4 * a : 4 * b] for a, b in zip(at, at[1:], strict=False)]
                        keys = shard.keys[i : i + len(each)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys, mask=keys == -(2**63)), pa.array(np.array(bounds[:-1], dtype=np.int64) + first), pa.array(np.diff(bounds)),
                             pa.array(list(map(zlib.crc32, each)), pa.int64()), pa.array(list(map(bytes, each)), pa.binary())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32", "ids"])

    return (
        manifest.select("path", "first").repartition(n, "path")
        .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    )
