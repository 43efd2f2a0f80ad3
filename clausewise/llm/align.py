"""Operator 12: alignment of two tokenizers by bitsets of token ends.

Texts are encoded by a byte-level BPE (A) and a piece model (B), slice by slice.  The ends of A's and of
B's tokens are bits over the bytes of a slice, packed into 64-bit words.  Their AND holds the cuts that
both share; ranks by popcount turn a cut into the number of tokens before it, so a group is a range of A
tokens and a range of B tokens.  Their OR holds the ends of the stretches on which exactly one token of
each side lies: every overlapping pair of tokens has one such stretch, so the links of all groups
expand without looking at pairs that do not overlap.

How many documents hold a pair of ids is counted over all slices.  A slice asks once for each of its
different pairs, whatever the number of its documents: (slice, pair) rows are dealt by the A id, counted
and compared there, and go back to their slice, which meanwhile lies in a file of the shared folder.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import ByteBpe, byte_letters
from .common import KEPT, _hadoop_path, byte_groups, filesystem, fresh_path, lean, materialize, small_batches, worker_for

_LOADED: dict = {}


class Bits:
    """A packed bitset with a rank directory."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def at(cls, places: np.ndarray, size: int) -> "Bits":
        bits = np.zeros(-(-max(size, 1) // 64) * 64, dtype=bool)
        bits[places] = True
        return cls(np.packbits(bits, bitorder="little").view("<u8"))

    def rank(self, places: np.ndarray) -> np.ndarray:
        """How many bits are set before each place."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        below = self.words[np.minimum(word, len(self.words) - 1)] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.ones[word] + np.where(bit > 0, np.bitwise_count(below), 0)

    def select(self) -> np.ndarray:
        """Places of all bits that are set."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


class Vocabulary:
    """Bytes of every id."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.repeat(self.begin[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


class PieceEncoder:
    """Ids of a sentencepiece model for texts that begin with a blank (the one the model would add).

    No piece holds a blank after another character and none holds a line break, so no merge crosses the
    place before a run of blanks or around a line break: parts cut there are encoded alone, each different
    part of a slice once.  A model with other pieces encodes whole texts.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.blank = self.model.piece_to_id("▁")
        self.parted = not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces) and not self.model.is_unknown(self.blank)
        self.bytes = Vocabulary([
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)])

    def _parts(self, said: list[str]) -> list[list[int]]:
        done = self.model.encode([p if p[0] == "\n" else p[1:] for p in said], num_threads=1)
        # a part " " has nothing left to encode; a part that begins with a break gets a blank before it
        return [[self.blank] if p == " " else ids[1:] if p[0] == "\n" else ids for p, ids in zip(said, done, strict=True)]

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (an Arrow array of large strings) and n + 1 bounds."""
        import pyarrow as pa

        if not self.parted:
            done = [ids for ids in self.model.encode([t[1:] for t in texts.to_pylist()], num_threads=1)]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in done])]).astype(np.int64)
            return np.fromiter((i for ids in done for i in ids), dtype=np.int64, count=int(bounds[-1])), bounds
        edge = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[edge[0] : edge[-1]]
        edge = edge - edge[0]
        space = data == 32
        fresh = space.copy()
        fresh[1:] &= ~space[:-1]
        fresh |= data == 10
        fresh[edge[:-1]] = True
        begin = np.flatnonzero(fresh)
        cut = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data))
        coded = cut.dictionary_encode()
        done = self._parts(coded.dictionary.to_pylist())
        sizes = np.array([len(x) for x in done], dtype=np.int64)
        ids = np.fromiter((i for x in done for i in x), dtype=np.int64, count=int(sizes.sum()))
        starts, which = np.cumsum(sizes) - sizes, coded.indices.to_numpy()
        size = sizes[which]
        ends = np.cumsum(size)
        out = ids[np.repeat(starts[which] - (ends - size), size) + np.arange(ends[-1])]
        return out, np.concatenate([[0], ends])[np.searchsorted(begin, edge)]


def _encoders(a: str, b: str):
    worker_for("align")
    if (a, b) not in _LOADED:
        first = ByteBpe(a)
        first.tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        code = {c: i for i, c in enumerate(byte_letters())}
        said = [first.tokenizer.id_to_token(i) or "" for i in range(first.tokenizer.get_vocab_size())]
        # an entry with other letters (a special token) is no text and fails the comparison of bytes
        letters = Vocabulary([bytes(code[c] for c in t) if all(c in code for c in t) else b"" for t in said])
        _LOADED[a, b] = first, letters, PieceEncoder(b)
    KEPT["align"] = _LOADED.clear
    return _LOADED[a, b]


def faithful(data: np.ndarray, edge: np.ndarray, joined: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text ``data[edge[i]:edge[i + 1]]``, whether its joined tokens are the same bytes."""
    same = np.diff(edge) == np.diff(bounds)
    if same.all() and np.array_equal(data, joined):
        return same
    return np.array([s and np.array_equal(data[edge[i] : edge[i + 1]], joined[bounds[i] : bounds[i + 1]]) for i, s in enumerate(same)], dtype=bool)


def decimal(ids: np.ndarray, signs: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Ids in decimal, each with its sign behind it; the text and where each one's begins."""
    width = len(str(int(ids.max(initial=0))))
    out = np.empty((len(ids), width + 1), dtype=np.uint8)
    rest = ids.copy()
    for k in range(width - 1, -1, -1):
        rest, out[:, k] = rest // 10, rest % 10 + 48
    out[:, width] = signs
    digits = np.ones(len(ids), dtype=np.int64)
    for k in range(1, width):
        digits += ids >= 10**k
    keep = np.arange(width + 1) >= (width - digits)[:, None]
    return out[keep].tobytes(), np.concatenate([[0], np.cumsum(digits + 1)])


class Alignment:
    """Groups and links of texts whose tokens are ``a`` and ``b``, with ``a_edge`` and ``b_edge`` the
    places where each text's begin, and ``edge`` the bytes; ``a_size`` and ``b_size``: bytes of the tokens."""

    def __init__(self, a_size, b_size, a_edge, b_edge, edge):
        total = int(edge[-1])
        in_a, in_b = Bits.at(np.cumsum(a_size) - 1, total), Bits.at(np.cumsum(b_size) - 1, total)
        cuts = Bits(in_a.words & in_b.words).select()
        self.a_stop, self.b_stop = in_a.rank(cuts + 1), in_b.rank(cuts + 1)  # tokens up to each cut
        stretch = Bits(in_a.words | in_b.words).select()
        self.link_a, self.link_b = in_a.rank(stretch), in_b.rank(stretch)
        self.group_edge = np.searchsorted(cuts, edge)
        self.link_edge = np.searchsorted(stretch, edge)
        self.a_edge, self.b_edge = a_edge, b_edge

    def groups(self, a: np.ndarray, b: np.ndarray) -> list[memoryview]:
        """``a1,a2|b1;a3|b2,b3`` of each text."""
        ids, signs = np.empty(len(a) + len(b), dtype=np.int64), np.full(len(a) + len(b), ord(","), dtype=np.uint8)
        a_many, b_many = np.diff(self.a_stop, prepend=0), np.diff(self.b_stop, prepend=0)
        ids[np.arange(len(a)) + np.repeat(self.b_stop - b_many, a_many)] = a
        ids[np.arange(len(b)) + np.repeat(self.a_stop, b_many)] = b
        signs[self.a_stop + self.b_stop - b_many - 1] = ord("|")
        signs[self.a_stop + self.b_stop - 1] = ord(";")
        text, at = decimal(ids, signs)
        at, view = at[self.a_edge + self.b_edge].tolist(), memoryview(text)
        return [view[x : max(x, y - 1)] for x, y in zip(at, at[1:], strict=False)]


def align(docs: DataFrame, first: str, second: str, slice_bytes: int = 2 << 20) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    ``first``: file of a byte-level BPE, which gets a blank before the text; ``second``: piece model, which
    adds one itself.  A text that is null or empty, or whose joined tokens are not the blank and the
    text in bytes (U+2581, for one), has no tokens: zeros, and '' for the hash.  Rows are documents one
    by one: those that repeat a doc_id, or have none, stay and count.  A tie for the highest count of an A id
    makes all of its tied pairs best.  Long texts are encoded whole; a
    text longer than ``slice_bytes`` is a slice alone.  Other columns are not read; an empty table gives
    no rows.  An attempt of a task writes files of its own name, and the manifest names those that count.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    root = fresh_path(spark, "aligned")
    fs, at = _hadoop_path(spark, root)
    fs.deleteOnExit(at)
    small_batches(spark, slice_bytes)

    @lean
    def cut(batches):
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark import TaskContext

        bpe, letters, pieces = _encoders(first, second)
        part, number = TaskContext.get().partitionId(), 0
        for batch in (g for b in batches for g in byte_groups(b, limit=slice_bytes)):
            names, texts = batch.column(0), batch.column(1).cast(pa.large_string())
            n = len(names)
            full = np.flatnonzero(pc.binary_length(texts).to_numpy() > 0)
            texts = pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts.take(pa.array(full)), pa.scalar("", texts.type))
            own = np.zeros((4, n), dtype=np.int64)
            shas = [""] * n
            pair_edge, pair, times, asked, holds = np.zeros(n + 1, dtype=np.int64), *(np.zeros(0, dtype=np.int64),) * 4
            if len(full):
                edge = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
                data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[edge[0] : edge[-1]]
                edge = edge - edge[0]
                good, sides = np.ones(len(full), dtype=bool), []
                for encoder, entries in ((bpe, letters), (pieces, pieces.bytes)):
                    ids, bounds = encoder.encode(texts)
                    ids = ids.astype(np.int64)
                    reach = np.concatenate([[0], np.cumsum(entries.size[ids])])
                    good &= faithful(data, edge, entries.joined(ids), reach[bounds])
                    sides.append((ids, entries.size, bounds))
                    del reach
                if not good.all():
                    sides = [(ids[np.repeat(good, np.diff(b))], size, np.concatenate([[0], np.cumsum(np.diff(b)[good])])) for ids, size, b in sides]
                    full, edge = full[good], np.concatenate([[0], np.cumsum(np.diff(edge)[good])])
                del data, texts
            if len(full):
                (a, a_size, a_edge), (b, b_size, b_edge) = sides
                found = Alignment(a_size[a], b_size[b], a_edge, b_edge, edge)
                for row, at in enumerate((a_edge, b_edge, found.group_edge, found.link_edge)):
                    own[row, full] = np.diff(at)
                for k, text in zip(full.tolist(), found.groups(a, b), strict=True):
                    shas[k] = hashlib.sha256(text).hexdigest()
                asked, inverse = np.unique(a[found.link_a] << 32 | b[found.link_b], return_inverse=True)
                sides.clear()
                owner = np.repeat(full, np.diff(found.link_edge))
                place, times = np.unique(owner * len(asked) + inverse, return_counts=True)
                pair, owner = place % len(asked), place // len(asked)
                pair_edge = np.searchsorted(owner, np.arange(n + 1))
                holds = np.bincount(pair, minlength=len(asked))
                del found, inverse, place, owner
            store, folder = filesystem(root)
            store.create_dir(folder, recursive=True)
            name = f"slice-{part:08d}-{number:06d}-{uuid.uuid4().hex}.parquet"
            lists = pa.array(pair_edge, pa.int32())
            table = pa.table({
                "doc_id": names, "n_a": own[0], "n_b": own[1], "n_groups": own[2], "n_links": own[3], "groups_sha256": shas,
                "pairs": pa.ListArray.from_arrays(lists, pa.array(pair, pa.int32())), "times": pa.ListArray.from_arrays(lists, pa.array(times, pa.int32()))})
            with store.open_output_stream(f"{folder}/{name}") as out:
                pq.write_table(table, out, compression="zstd", use_dictionary=["times"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([part << 32 | number], pa.int64()), pa.array([f"{root}/{name}"]), pa.array([asked], pa.list_(pa.int64())), pa.array([holds], pa.list_(pa.int32()))],
                names=["slice", "path", "pairs", "docs"])
            number += 1

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    slices = materialize(texts.mapInArrow(cut, "slice long, path string, pairs array<long>, docs array<int>"), "slices")
    asked = slices.select("slice", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "x")).select(
        "slice", "at", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"), F.shiftright("x.pairs", 32).cast("int").alias("a"))
    # a slice holds a pair once, so a pair has at most as many rows as there are slices; one exchange serves both windows
    counts = asked.repartition("a").withColumn("count", F.sum("docs").over(Window.partitionBy("a", "pair"))).withColumn(
        "best", F.col("count") == F.max("count").over(Window.partitionBy("a"))).select("slice", "at", "count", "best")

    def answer(left, right):
        import pyarrow.parquet as pq

        parts = []
        at = right.column("at").to_numpy()
        count, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=bool)
        count[at], best[at] = right.column("count").to_numpy(), right.column("best").to_numpy()
        for path in left.column("path").to_pylist():
            store, place = filesystem(path)
            table = pq.read_table(place, filesystem=store).combine_chunks()
            pairs, times = (table.column(c).combine_chunks() for c in ("pairs", "times"))
            edge, pair, many = pairs.offsets.to_numpy(), pairs.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            sums = [np.concatenate([[0], np.cumsum(x)])[edge] for x in (many * best[pair], many * count[pair])]
            parts.append(pa.table({
                **{c: table.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
                "n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1]), "groups_sha256": table.column("groups_sha256")}))
        return pa.concat_tables(parts) if parts else pa.table({c: pa.array([], t) for c, t in OUT})

    return slices.select("slice", "path").groupBy("slice").cogroup(counts.groupBy("slice")).applyInArrow(
        answer, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


OUT = (("doc_id", "int64"), ("n_a", "int64"), ("n_b", "int64"), ("n_groups", "int64"), ("n_links", "int64"), ("n_best", "int64"),
       ("count_sum", "int64"), ("groups_sha256", "string"))
