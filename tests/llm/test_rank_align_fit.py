"""Operators 11 to 13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, columns of any name."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from clausewise.llm import align, best_fit, lexical
from clausewise.llm.bpe import byte_letters
from clausewise.llm.common import tokenizer_path

BPE = tokenizer_path("byte_bpe_50k.json")
PIECES = tokenizer_path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, rank int, score double, key string, kind int, size string, term string"
LONG = " ".join(f"w{i * 7919 % 9_001}" for i in range(12_000))
ROWS = [
    (1, "The cat sat on the mat"), (2, None), (3, ""), (4, "a cat, A CAT; naïve Über cat's"), (4, "a cat, A CAT; naïve Über cat's"), (None, "lone cat"), (None, "lone cat"),
    (5, "!!! ... ()"), (7, LONG), (8, "日本 語\n\n x  cat"), (9, "sat sat sat"), (10, "\tcat\x00dog \x0b"), (11, "cat <|endoftext|> </s> <0x41> <unk>"), (12, "two  blanks \n here "),
    (13, " "), (14, "a▁b"), (15, "mat " * 700), (16, "mat\n" * 9), (17, "\n"), (18, "0x0A café ﬁ½ 　 end"), (-3, "mat"), (19, "x" * 3000),
]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 0, 0.5, "k", 1, "s", "t") for i, t in rows], SCHEMA).repartition(3)


# ---- 11 lexical search ------------------------------------------------------

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute_search(docs, items, k):
    bags = [(i, words(t)) for i, t in docs]
    bags = [(i, w, Counter(w)) for i, w in bags if w]
    n, total = len(bags), sum(len(w) for _, w, _ in bags)
    df = Counter(t for _, _, c in bags for t in c)
    out = set()
    for item, text in set(items):
        scored = []
        for i, w, c in bags:
            m = 100 - 25 + (25 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 12 * m)) for t in words(text) if t in c)
            if s > 0:
                scored.append((-s, i is None, i or 0))
        out |= {(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k], 1)}
    return out


ITEMS = [(1, "cat"), (2, "the MAT the sat"), (3, None), (4, "zzz nothing"), (5, "naïve w7919 x lone"), (5, "sat"), (1, "cat"), (6, ""), (None, "mat")]


@pytest.mark.parametrize("shard_bytes,wave_terms", [(1 << 20, 1 << 17), (200, 3)])
def test_search_is_brute_force(spark, shard_bytes, wave_terms):
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, doc_id int")
    found = lexical.search(lexical.build_index(docs_of(spark, ROWS), shard_bytes), items, k=4, wave_terms=wave_terms)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert {tuple(r) for r in found.collect()} == brute_search(ROWS, ITEMS, 4)
    assert found.count() == len(brute_search(ROWS, ITEMS, 4))


def test_search_of_nothing(spark):
    items = spark.createDataFrame([(1, "cat")], "item_id long, text string")
    assert lexical.search(lexical.build_index(docs_of(spark, [])), items).count() == 0
    assert lexical.search(lexical.build_index(docs_of(spark, [(1, None), (2, "...")])), items).count() == 0
    assert lexical.search(lexical.build_index(docs_of(spark, ROWS)), items.where("false")).count() == 0


def test_ties_at_the_cut_go_to_the_smaller_id():
    best, rng = lexical.Best(5), np.random.default_rng(1)
    score, ident = rng.integers(0, 4, 200), rng.permutation(200)
    for at in range(0, 200, 40):
        best.add(score[at : at + 40], ident[at : at + 40], np.zeros(40, dtype=bool))
    assert list(zip(best.score.tolist(), best.ident.tolist())) == [(s, i) for s, i in sorted(zip(score.tolist(), ident.tolist()), key=lambda x: (-x[0], x[1]))[:5]]


# ---- 12 alignment -----------------------------------------------------------


def brute_align(rows):
    bpe, pieces = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    bpe.encode_special_tokens = True
    code = {c: i for i, c in enumerate(byte_letters())}
    done = []
    for i, text in rows:
        a = bpe.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        sides = []
        for ids, decode in ((a, lambda x: bytes(code[c] for c in bpe.id_to_token(x))),
                            (b, lambda x: bytes([int(pieces.id_to_piece(x)[3:5], 16)]) if pieces.is_byte(x) else pieces.id_to_piece(x).replace("▁", " ").encode())):
            raw = [decode(x) for x in ids]
            sides.append((b"".join(raw), np.cumsum([len(x) for x in raw]).tolist()))
        if not text or any(joined != (" " + text).encode() for joined, _ in sides):
            done.append((i, [], [], [], ""))
            continue
        (_, ea), (_, eb) = sides
        sa, sb = [0, *ea[:-1]], [0, *eb[:-1]]
        links, j = [], 0
        for x in range(len(a)):
            while eb[j] <= sa[x]:
                j += 1
            y = j
            while y < len(b) and sb[y] < ea[x]:
                links.append((a[x], b[y]))
                y += 1
        cuts, groups, x, y = sorted(set(ea) & set(eb)), [], 0, 0
        for cut in cuts:
            p, q = ea.index(cut, x) + 1, eb.index(cut, y) + 1
            groups.append(",".join(map(str, a[x:p])) + "|" + ",".join(map(str, b[y:q])))
            x, y = p, q
        done.append((i, a, b, links, ";".join(groups)))
    holds = Counter(p for _, _, _, links, _ in done for p in set(links))
    best = defaultdict(int)
    for (x, _), n in holds.items():
        best[x] = max(best[x], n)
    return Counter(
        (i, len(a), len(b), g.count("|"), len(links), sum(holds[p] == best[p[0]] for p in links), sum(holds[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "")
        for i, a, b, links, g in done)


@pytest.mark.parametrize("slice_bytes", [4 << 20, 64])
def test_align_is_brute_force(spark, slice_bytes):
    rows = [r if r[0] != 7 else (7, LONG[:20_000]) for r in ROWS]
    found = align.align(docs_of(spark, rows), BPE, PIECES, slice_bytes)
    assert Counter(tuple(r) for r in found.collect()) == brute_align(rows)


def test_align_of_the_tables(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text")
    assert Counter(tuple(r) for r in align.align(docs, BPE, PIECES).collect()) == brute_align([tuple(r) for r in docs.collect()])


def test_align_of_nothing(spark):
    assert align.align(docs_of(spark, []), BPE, PIECES).count() == 0
    assert [tuple(r) for r in align.align(docs_of(spark, [(1, None)]), BPE, PIECES).collect()] == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_pieces_of_parts_are_those_of_the_whole():
    import pyarrow as pa

    encoder, rng = align.PieceEncoder(PIECES), np.random.default_rng(3)
    letters = list("ab tTé日\n  .,0<>x") + ["the", " and", "\n\n", "   ", "▁", "\t", "　", "ing", "\x00", "😀", "<s>"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 40))) for _ in range(600)]
    ids, bounds = encoder.encode(pa.array([" " + t for t in texts], pa.large_string()))
    for t, a, b in zip(texts, bounds, bounds[1:]):
        if "▁" not in t:
            assert ids[a:b].tolist() == encoder.model.encode(t), repr(t)


def test_bits():
    rng = np.random.default_rng(5)
    for size in (1, 63, 64, 65, 1000):
        at = np.flatnonzero(rng.random(size) < 0.3)
        bits = align.Bits.at(at, size)
        assert bits.select().tolist() == at.tolist()
        assert bits.rank(np.arange(size + 1)).tolist() == [int((at < p).sum()) for p in range(size + 1)]


# ---- 13 best fit ------------------------------------------------------------


def best_fit_decreasing(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return len(rooms)


def test_one_range_is_best_fit_decreasing():
    rng = np.random.default_rng(7)
    for _ in range(60):
        capacity = int(rng.integers(5, 60))
        sizes = rng.integers(1, capacity + 1, rng.integers(1, 120))
        gap, place, rest = best_fit.sweep(sizes, np.zeros(0, dtype=np.int64), capacity, True)
        assert len(rest) == best_fit_decreasing(sizes.tolist(), capacity)
        for g in range(len(rest)):
            mine = np.flatnonzero(gap == g)
            mine = mine[np.argsort(place[mine])]
            ends = np.cumsum(sizes[mine])
            assert place[mine].tolist() == [0, *ends[:-1]] and rest[g] == capacity - ends[-1]


def test_carry_serves_ranks_once():
    rng = np.random.default_rng(9)
    for _ in range(100):
        docs, gaps = rng.integers(0, 6, 21), rng.integers(0, 6, 21)
        docs[0] = gaps[0] = 0
        per_size, per_room = defaultdict(int), defaultdict(int)
        for size, at, n, room, first, per in best_fit.carry(docs, gaps):
            assert at == per_size[size] and first == per_room[room] and per == room // size and size <= room
            per_size[size] += n
            per_room[room] += -(-n // per)
        assert all(per_size[s] <= docs[s] for s in per_size) and all(per_room[c] <= gaps[c] for c in per_room)
        # no document is left that a gap still holds
        left = [s for s in range(1, 21) if docs[s] > per_size[s]]
        assert not left or all(gaps[c] == per_room[c] for c in range(min(left), 21))


@pytest.mark.parametrize("range_rows", [40, 400, 1 << 16])
def test_rounds_pack_all(spark, range_rows):
    rng = np.random.default_rng(11)
    sizes = np.concatenate([rng.integers(1, 101, 700), np.full(500, 30), rng.integers(1, 8, 300), np.full(20, 100)])
    items = spark.createDataFrame([(int(k) * 3 - 500, int(s)) for k, s in enumerate(sizes)], "key long, size long").repartition(4)
    rows = items.join(best_fit.best_fit(items, 100, range_rows), "key").collect()
    assert len(rows) == len(sizes) and len({r["key"] for r in rows}) == len(sizes)
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["size"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([s for _, s in parts])[:-1]] and sum(s for _, s in parts) <= 100
    least = best_fit_decreasing(sizes.tolist(), 100)
    assert len(by) <= least * 1.02 + 1


def test_pieces_are_cut_as_said(spark):
    rows = best_fit.pack_best_fit(docs_of(spark, [*ROWS, (30, "word " * 2047)]), BPE, length=64, end_id=2, range_rows=8).collect()
    encoder, got = Tokenizer.from_file(BPE), defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    want = defaultdict(list)
    for i, t in [*ROWS, (30, "word " * 2047)]:
        ids = encoder.encode(t or "", add_special_tokens=False).ids + [2]
        head, at, piece = len(ids) % 64 or 64, 0, 0
        while at < len(ids):
            n = head if at == 0 else 64
            want[i].append((piece, at, n, zlib.crc32(np.array(ids[at : at + n], dtype="<u4").tobytes())))
            at, piece = at + n, piece + 1
    assert {i: sorted(v) for i, v in got.items()} == {i: sorted(v) for i, v in want.items()}
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([s for _, s in parts])[:-1]] and sum(s for _, s in parts) <= 64
    assert best_fit.pack_best_fit(docs_of(spark, []), BPE).count() == 0
