"""Operator 13: best-fit packing in bulk-synchronous rounds.

Documents over the capacity are cut; whole cuts are sequences of their own, and what is over half the
capacity must open one.  The rest is packed in rounds.  A round range-sorts the documents that are left
and the gaps by size; every task sweeps its range from the largest document on, and each takes the
smallest gap that holds it (its successor), documents of one size filling a gap before the next one.
What finds no partner within its range meets the gaps of all other ranges: documents and gaps of
one size are ranked, the sweep runs over the counts of the sizes (never more than the capacity), and
rank decides which document gets which gap, a gap serving documents of one size a round.  Then the gaps
are updated, sequences are opened by the largest documents where the gaps cannot hold what is left, and
the next round begins.  When one range holds all that is left, its sweep opens sequences too and ends
the packing.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import ByteBpe
from .common import byte_groups, discard, lean, materialize, small_batches

PLACED, DOC, GAP, OPENER = 0, 1, 2, 3


class Buckets:
    """Gaps by their room; the smallest room that holds a size is found first."""

    def __init__(self, capacity: int):
        self.blocks: list[list[np.ndarray]] = [[] for _ in range(capacity + 1)]
        self.any = np.zeros(capacity + 1, dtype=bool)

    def put(self, room: int, gaps: np.ndarray) -> None:
        if room and len(gaps):
            self.blocks[room].append(gaps)
            self.any[room] = True

    def take(self, size: int, want) -> tuple[int, np.ndarray] | None:
        """Gaps of the least room of at least ``size``, ``want(room)`` at most."""
        room = size + int(self.any[size:].argmax())
        if not self.any[room]:
            return None
        block, most = self.blocks[room].pop(), want(room)
        if len(block) > most:
            self.blocks[room].append(block[most:])
            block = block[:most]
        self.any[room] = bool(self.blocks[room])
        return room, block


def sweep(sizes: np.ndarray, rooms: np.ndarray, capacity: int, opens: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best fit of documents, largest first, into gaps: the gap of each (-1: none), its place in the
    sequence, and the room left in each gap.  With ``opens``, gaps beyond those given are new sequences,
    and every document finds one."""
    gap, place = np.full(len(sizes), -1, dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    left = Buckets(capacity)
    for room in np.unique(rooms):
        left.put(int(room), np.flatnonzero(rooms == room))
    known = len(rooms)
    order = np.argsort(-sizes, kind="stable")
    values, first = np.unique(-sizes[order], return_index=True)
    stops = np.append(first, len(sizes))
    for value, at, stop in zip((-values).tolist(), stops.tolist(), stops[1:].tolist(), strict=False):
        while at < stop:
            got = left.take(value, lambda room: -(-(stop - at) // (room // value)))
            if got is None:
                if not opens:
                    break
                many = -(-(stop - at) // (capacity // value))
                left.put(capacity, np.arange(known, known + many))
                known += many
                continue
            room, block = got
            per = room // value
            n = min(stop - at, per * len(block))
            nth = np.arange(n)
            mine = order[at : at + n]
            gap[mine], place[mine] = block[nth // per], capacity - room + value * (nth % per)
            left.put(room - per * value, block[: n // per])
            if n % per:
                left.put(room - n % per * value, block[n // per : n // per + 1])
            at += n
    rest = np.zeros(known, dtype=np.int64)
    for room in np.flatnonzero(left.any):
        rest[np.concatenate(left.blocks[room])] = room
    return gap, place, rest


def carry(docs: np.ndarray, gaps: np.ndarray) -> list[tuple[int, int, int, int, int, int]]:
    """The sweep over counts: ``docs[s]`` documents of size s, ``gaps[c]`` gaps of room c.  Rows (size, first
    document rank, documents, room, first gap rank, documents a gap); a gap serves one size."""
    used, out = np.zeros(len(gaps), dtype=np.int64), []
    for size in np.flatnonzero(docs)[::-1].tolist():
        at = 0
        while at < docs[size]:
            open_ = np.flatnonzero(gaps[size:] > used[size:])
            if not len(open_):
                break
            room = size + int(open_[0])
            per = room // size
            many = int(min(gaps[room] - used[room], -(-(docs[size] - at) // per)))
            n = int(min(docs[size] - at, per * many))
            out.append((size, at, n, room, int(used[room]), per))
            used[room] += many
            at += n
    return out


def best_fit(items: DataFrame, capacity: int, range_rows: int = 1 << 16) -> DataFrame:
    """(key, sequence_id, offset) for every row of ``items`` (key: unique long, size: 1 to ``capacity``);
    a sequence is named by the key of what opened it.  ``range_rows``: rows of a range."""
    spark = items.sparkSession
    opens = F.col("size") * 2 > capacity
    placed = [items.where(opens).select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))]
    state = items.select(
        F.when(opens, F.lit(GAP)).otherwise(F.lit(DOC)).alias("kind"), "key",
        F.when(opens, capacity - F.col("size")).otherwise(F.col("size")).cast("int").alias("size")).where("size > 0")
    state = materialize(state, "packing-state")

    while True:
        seen = {r["kind"]: r for r in state.groupBy("kind").agg(F.count("*").alias("n"), F.min("size").alias("least")).collect()}
        if DOC not in seen:
            break
        least, rows = seen[DOC]["least"], sum(r["n"] for r in seen.values())
        ranges = -(-rows // range_rows)
        live = state.where((F.col("kind") == DOC) | (F.col("size") >= least))  # a gap below every document is done
        if ranges == 1:
            ranged = live.repartition(1).sortWithinPartitions(F.desc("size"), "key")
        else:
            ranged = live.repartitionByRange(ranges, F.desc("size"), F.xxhash64("key"), F.col("key")).sortWithinPartitions(
                F.desc("size"), F.xxhash64("key"), F.col("key"))

        @lean
        def match(batches, last=ranges == 1):
            import pyarrow as pa
            from pyspark import TaskContext

            table = pa.Table.from_batches(list(batches))
            if not table.num_rows:
                return
            kind, key, size = (table.column(c).to_numpy() for c in ("kind", "key", "size"))
            docs, gaps = np.flatnonzero(kind == DOC), np.flatnonzero(kind == GAP)
            gap, place, rest = sweep(size[docs].astype(np.int64), size[gaps].astype(np.int64), capacity, last)
            owner = np.concatenate([key[gaps], np.zeros(len(rest) - len(gaps), dtype=np.int64)])
            new = (gap >= len(gaps)) & (place == 0)
            owner[gap[new]] = key[docs[new]]
            done = gap >= 0
            part = TaskContext.get().partitionId()

            def out(kind, keys, sizes, sequence, offset):
                order = np.argsort(sizes, kind="stable")
                runs = np.flatnonzero(np.diff(sizes[order], prepend=-1))
                nth = np.empty(len(sizes), dtype=np.int64)
                nth[order] = np.arange(len(sizes)) - np.repeat(runs, np.diff(np.append(runs, len(sizes))))
                n = len(keys)
                return pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, kind), pa.int32()), pa.array(keys), pa.array(sizes, pa.int32()), pa.array(np.full(n, part), pa.int32()), pa.array(nth),
                     pa.array(sequence), pa.array(offset)],
                    names=["kind", "key", "size", "part", "nth", "sequence_id", "offset"])

            yield out(PLACED, key[docs[done]], size[docs[done]], owner[gap[done]], place[done])
            if not last:
                yield out(DOC, key[docs[~done]], size[docs[~done]], key[docs[~done]], place[~done])
                keep = rest > 0
                yield out(GAP, key[gaps[keep]], rest[keep], key[gaps[keep]], rest[keep])

        swept = materialize(ranged.mapInArrow(match, "kind int, key long, size int, part int, nth long, sequence_id long, offset long"), "swept")
        placed.append(swept.where(F.col("kind") == PLACED).select("key", "sequence_id", "offset"))
        discard(state)
        if ranges == 1:
            break
        left = swept.where(F.col("kind") != PLACED).select("kind", "key", "size", "part", "nth")
        counts = left.groupBy("kind", "size", "part").agg(F.count("*").alias("n"))
        docs, gaps = np.zeros(capacity + 1, dtype=np.int64), np.zeros(capacity + 1, dtype=np.int64)
        for kind, size, n in counts.groupBy("kind", "size").agg(F.sum("n")).collect():  # two rows a size at most
            (docs if kind == DOC else gaps)[size] = n
        deals = carry(docs, gaps)
        served = np.zeros(capacity + 1, dtype=np.int64)
        for size, _, n, *_ in deals:
            served[size] += n
        sizes = np.arange(capacity + 1)
        more = int((docs - served) @ sizes)
        room = int(gaps @ sizes) - int(served @ sizes)
        need = -(-max(more - room, 0 if deals else more) // capacity)  # sequences that any packing must open now
        opened = np.zeros(capacity + 1, dtype=np.int64)
        for size in np.flatnonzero(docs - served)[::-1]:
            opened[size] = min(need - opened.sum(), docs[size] - served[size])
        by_size = {s: np.array([d[1:] for d in deals if d[0] == s]) for s in {d[0] for d in deals}}
        by_room = {c: np.array([(d[4], d[0], d[2], d[5]) for d in deals if d[3] == c]) for c in {d[3] for d in deals}}

        @lean
        def deal(batches, by_size=by_size, by_room=by_room, served=served, opened=opened):
            import pyarrow as pa

            for batch in batches:
                kind, key, size, rank = (batch.column(c).to_numpy().copy() for c in ("kind", "key", "size", "rank"))
                gap_room, gap_rank, offset = np.zeros(len(key), dtype=np.int32), rank.copy(), np.zeros(len(key), dtype=np.int64)
                for s in np.unique(size[kind == DOC]).tolist():
                    mine = np.flatnonzero((kind == DOC) & (size == s))
                    got = mine[rank[mine] < served[s]]
                    if len(got):
                        rows = by_size[s]
                        at = rows[np.searchsorted(rows[:, 0], rank[got], side="right") - 1]
                        nth = rank[got] - at[:, 0]
                        kind[got], gap_room[got], gap_rank[got] = PLACED, at[:, 2], at[:, 3] + nth // at[:, 4]
                        offset[got] = capacity - at[:, 2] + s * (nth % at[:, 4])
                    kind[mine[(rank[mine] >= served[s]) & (rank[mine] < served[s] + opened[s])]] = OPENER
                left = size.copy()
                for c in np.unique(size[kind == GAP]).tolist():
                    mine = np.flatnonzero((kind == GAP) & (size == c))
                    gap_room[mine] = c
                    if c in by_room:
                        rows = by_room[c]
                        at = rows[np.searchsorted(rows[:, 0], rank[mine], side="right") - 1]
                        left[mine] = c - at[:, 1] * np.clip(at[:, 2] - (rank[mine] - at[:, 0]) * at[:, 3], 0, at[:, 3])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(kind, pa.int32()), pa.array(key), pa.array(left, pa.int32()), pa.array(gap_room, pa.int32()), pa.array(gap_rank), pa.array(offset)],
                    names=["kind", "key", "size", "room", "rank", "offset"])

        before = Window.partitionBy("kind", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        first = counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
        ranked = left.join(first, ["kind", "size", "part"]).select("kind", "key", "size", (F.col("first") + F.col("nth")).alias("rank"))
        dealt = materialize(ranked.mapInArrow(deal, "kind int, key long, size int, room int, rank long, offset long"), "dealt")
        gap = dealt.where(F.col("kind") == GAP).select("room", "rank", F.col("key").alias("sequence_id"))
        placed.append(dealt.where(F.col("kind") == PLACED).select("key", "room", "rank", "offset").join(gap, ["room", "rank"]).select("key", "sequence_id", "offset"))
        opener = dealt.where(F.col("kind") == OPENER)
        placed.append(opener.select("key", F.col("key").alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
        state = materialize(
            dealt.where(F.col("kind").isin(DOC, GAP) & (F.col("size") > 0)).select("kind", "key", "size")
            .unionByName(opener.select(F.lit(GAP).alias("kind"), "key", (capacity - F.col("size")).cast("int").alias("size"))), "packing-state")

    whole = placed[0]
    for part in placed[1:]:
        whole = whole.unionByName(part)
    return whole


def pack_best_fit(docs: DataFrame, tokenizer: str, length: int = 1024, end_id: int = 2, range_rows: int = 1 << 16) -> DataFrame:
    """Pieces of all documents, each in its place of a sequence of at most ``length`` tokens.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset, key.  Only a document of more than
    ``length`` tokens is cut, into pieces of ``length``, the first one shorter if it must.  A null text is
    empty (the end id alone).  Rows are packed one by one: rows that repeat a doc_id, or have none, are
    documents of their own; pieces of one length change places freely, and their row keys decide.  Long
    texts are encoded whole.  An empty table gives no pieces; other columns
    are not read.
    """
    small_batches(docs.sparkSession)

    @lean
    def cut(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = ByteBpe.load(tokenizer)
        part, row = TaskContext.get().partitionId(), 0
        for batch in (g for b in batches for g in byte_groups(b, limit=2_000_000)):
            ids, bounds = encoder.encode(batch.column(1))
            raw = memoryview(np.insert(ids, bounds[1:], end_id).astype("<u4")).cast("B")
            bounds = bounds + np.arange(len(bounds))
            n = np.diff(bounds)
            many = -(-n // length)
            owner = np.repeat(np.arange(len(n)), many)
            piece = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many)
            head = (n - (many - 1) * length)[owner]  # length of the first piece
            start = np.where(piece == 0, 0, head + (piece - 1) * length)
            size = np.where(piece == 0, head, length)
            at = (bounds[owner] + start).tolist()
            crc = [zlib.crc32(raw[4 * a : 4 * (a + s)]) for a, s in zip(at, size.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(owner)), pa.array((part << 33) + row + np.arange(len(owner))), pa.array(piece, pa.int32()), pa.array(start),
                 pa.array(size), pa.array(crc, pa.int64())],
                names=["doc_id", "key", "piece", "start", "length", "ids_crc32"])
            row += len(owner)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    pieces = materialize(texts.mapInArrow(cut, "doc_id long, key long, piece int, start long, length long, ids_crc32 long"), "pieces")
    # a full piece is a sequence of its own and needs no round
    small = best_fit(pieces.where(F.col("length") < length).select("key", F.col("length").alias("size")), length, range_rows)
    full = pieces.where(F.col("length") == length).withColumns({"sequence_id": F.col("key"), "offset": F.lit(0).cast("long")})
    return pieces.where(F.col("length") < length).join(small, "key").unionByName(full).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "key")
