"""Operator 1: sampled segmentations over a SentencePiece vocabulary, and their decoding.

All segmentations of a text form a lattice.  Gumbel top-k draws k of them without replacement: give
every segmentation its log-probability plus Gumbel noise and take the k largest.  The noise is drawn
from the top: the largest over a set of paths is itself Gumbel distributed, so an A*-like search
keeps open sets of paths in a heap, each with the exact largest value it holds.  Popping a set emits
its best segmentation (a path drawn by conditional probabilities) and splits what is left by where a
path first turns off, each part with a Gumbel truncated below the value emitted.

Pieces never cross the blank before a word, so the lattice is a chain of word lattices; those of
all different words of a batch are built together in numpy, and the paths of all words are drawn
together, and so are the sets of paths that rows open next.  Randomness is a hash of (seed, row key,
sample or split, word, step), so a row's samples do not depend on partitions or batches.

The vocabulary is the model's own; the probability of a piece is taken from its place in the
vocabulary (rank r weighs 1 / (r + 10)), because a merge-ordered vocabulary has ranks for scores.
``alpha`` is the usual smoothing: a segmentation weighs its probability to that alpha.  A character
without a piece goes by its bytes.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_groups, lean, small_batches, worker_for

BLANK = "▁"
BYTE = 0x110000  # code units from here on stand for single bytes
_WORDS = re.compile(f"{BLANK}*[^{BLANK}]+|{BLANK}+")
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_LOADED: dict[tuple, "Vocabulary"] = {}


def mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + _M1).astype(np.uint64)
        x = (x ^ (x >> np.uint64(30))) * _M2
        x = (x ^ (x >> np.uint64(27))) * _M3
        return x ^ (x >> np.uint64(31))


def mixed(h, *parts) -> np.ndarray:
    """A hash of integers, carried on from the hash ``h``."""
    for p in parts:
        h = mix(np.asarray(p).astype(np.int64).view(np.uint64) ^ h)
    return h


def uniform(h: np.ndarray) -> np.ndarray:
    """Numbers strictly between 0 and 1 from hashes."""
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)


class Vocabulary:
    """Pieces by length, found by a hash of their code units; decoding by a table of bytes."""

    def __init__(self, path: str, alpha: float = 0.3):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.surface: list[bytes] = []
        by_length: dict[int, list[tuple[int, int]]] = {}
        spelled: dict[int, list[list[int]]] = {}
        self.chars: set[str] = set()
        weights = np.array([-math.log(i + 10) for i in range(size)])
        self.logp = alpha * (weights - np.log(np.exp(weights).sum()))
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.surface.append(bytes([value]))
                by_length.setdefault(1, []).append((int(self._hash(np.array([BYTE + value]))[0]), i))
                continue
            self.surface.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace(BLANK, " ").encode())
            if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                continue
            if len(piece) == 1:
                self.chars.add(piece)
            units = [ord(c) for c in piece]
            spelled.setdefault(len(piece), []).append(units)
            by_length.setdefault(len(piece), []).append((int(self._fold(np.array([units]))[0]), i))
        self.bytes = np.array([len(x) for x in self.surface], dtype=np.int64)
        self.begin = np.cumsum(self.bytes) - self.bytes
        self.joined = np.frombuffer(b"".join(self.surface), dtype=np.uint8)
        self.tables = {}
        for n, rows in by_length.items():
            rows.sort()
            self.tables[n] = (np.array([h for h, _ in rows], dtype=np.uint64), np.array([i for _, i in rows], dtype=np.int32))
        self.longest = max(self.tables)
        self.sieve = {}
        for n, (keys, _) in self.tables.items():
            seen = np.zeros(1 << 18, dtype=bool)
            seen[self._slot(keys)] = True
            self.sieve[n] = seen
        # beginnings of longer pieces: where none begins so, no longer piece is looked for
        self.opens = {n: np.zeros(1 << 18, dtype=bool) for n in range(1, self.longest + 1)}
        for n, rows in spelled.items():
            units = np.array(rows)
            h = np.zeros(len(units), dtype=np.uint64)
            with np.errstate(over="ignore"):
                for k in range(1, n):
                    h = h * _M3 + self._hash(units[:, k - 1])
                    self.opens[k][self._slot(h)] = True
        self.single = np.zeros(0x110000, dtype=bool)
        self.single[[ord(c) for c in self.chars]] = True
        # characters that no piece holds right after a letter, and is the line break in any piece
        plain = [model.id_to_piece(i) for i in range(size) if not model.is_byte(i)]
        after = {b for p in plain for a, b in zip(p, p[1:], strict=False) if a.isalpha()}
        self.marks = frozenset(".,;:!?\"'()") - after
        self.lines = not any("\n" in p for p in plain)

    @classmethod
    def load(cls, path: str, alpha: float) -> "Vocabulary":
        if (path, alpha) not in _LOADED:
            _LOADED[path, alpha] = cls(path, alpha)
        return _LOADED[path, alpha]

    @staticmethod
    def _hash(units: np.ndarray) -> np.ndarray:
        return mix(units.astype(np.uint64))

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return ((h >> np.uint64(40)) & np.uint64((1 << 18) - 1)).astype(np.int32)

    @classmethod
    def _fold(cls, rows: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = np.zeros(len(rows), dtype=np.uint64)
            for k in range(rows.shape[1]):
                h = h * _M3 + cls._hash(rows[:, k])
        return h

    def units(self, chars: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code units of words whose code points stand one after another, and the number of each word's."""
        odd = np.flatnonzero(~self.single[chars])
        if not len(odd):
            return chars, sizes
        raw = [chr(c).encode("utf-8", "surrogatepass") for c in chars[odd].tolist()]
        count = np.ones(len(chars), dtype=np.int64)
        count[odd] = [len(r) for r in raw]
        out = np.repeat(chars, count)
        out[np.repeat(~self.single[chars], count)] = BYTE + np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.int64)
        word = np.repeat(np.arange(len(sizes)), sizes)
        return out, np.bincount(word, weights=count, minlength=len(sizes)).astype(np.int64)

    def cut(self, word: str) -> list[str]:
        """Parts of a word that no piece joins, so that fewer different words are left."""
        out = []
        for part in re.split("(\n)", word) if self.lines else (word,):
            if len(part) > 1 and part[-1] in self.marks and part[-2].isalpha():
                out += [part[:-1], part[-1]]
            elif part:
                out.append(part)
        return out

    def cuts(self, data: np.ndarray, fresh: np.ndarray) -> None:
        """``cut`` on the UTF-8 of many words: ``fresh`` marks where words begin, and then where parts do."""
        if self.lines:
            line = np.flatnonzero(data == 10)
            fresh[line] = True
            fresh[line[line + 1 < len(data)] + 1] = True
        mark = np.zeros(256, dtype=bool)
        mark[[ord(c) for c in self.marks]] = True
        at = np.flatnonzero(mark[data] & ~fresh)
        at = at[np.append(fresh, True)[at + 1]]
        point, behind = data[at - 1].astype(np.int64), at - 1
        open_ = np.flatnonzero(point >= 128)  # bytes of one character, from its last
        point[open_] &= 63
        for shift in (6, 12, 18):
            if not len(open_):
                break
            behind[open_] -= 1
            byte = data[behind[open_]].astype(np.int64)
            lead = byte >= 192
            point[open_] |= np.where(lead, byte & (127 >> (shift // 6 + 1)), byte & 63) << shift
            open_ = open_[~lead]
        known, which = np.unique(point, return_inverse=True)
        fresh[at[np.array([chr(c).isalpha() for c in known.tolist()], dtype=bool)[which]]] = True

    def decode(self, ids) -> str:
        """Text of ids: pieces joined, bytes read as UTF-8, the blank in front dropped."""
        raw = b"".join(map(self.surface.__getitem__, ids))
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")

    def decoded_crc32(self, paths: list[np.ndarray]) -> list[int]:
        """crc32 of the UTF-8 of ``decode(ids)`` of each path's ids; what is ASCII needs no decoding."""
        ids = np.concatenate([np.zeros(0, dtype=np.int64), *paths])
        size = self.bytes[ids]
        ends = np.cumsum(size)
        data = self.joined[np.repeat(self.begin[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]
        high = np.concatenate([[0], np.cumsum(data >= 128)])
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum([len(p) for p in paths])]).astype(np.int64)].tolist()
        out, view = [], memoryview(data)
        for a, b in zip(bounds, bounds[1:], strict=False):
            if a < b and data[a] == 32:
                a += 1
            raw = view[a:b] if high[a] == high[b] else bytes(view[a:b]).decode("utf-8", "replace").encode()
            out.append(zlib.crc32(raw))
        return out


def escaped(text: str) -> str:
    return BLANK + text.replace(" ", BLANK) if text else ""


def words_of(text: str) -> list[str]:
    if not text:
        return []
    if "  " in text or BLANK in text or text[-1] == " " or text[0] == " ":
        return _WORDS.findall(escaped(text))
    return [BLANK + w for w in text.split(" ")]


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words one after another, and the number of each word's."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64), sizes


def numbered_parts(texts: list[str], vocabulary: Vocabulary) -> tuple[tuple[np.ndarray, np.ndarray], np.ndarray, np.ndarray]:
    """Different parts of words of all texts (``code_points``), the parts of the texts by number, and
    how many each text has."""
    import pyarrow as pa
    import pyarrow.compute as pc

    said = pa.array(texts, pa.large_string())
    full = pc.binary_length(said).to_numpy() > 0
    if not full.any() or pc.any(pc.match_substring(said, BLANK)).as_py():
        rows = [[x for w in words_of(t) for x in vocabulary.cut(w)] for t in texts]
        whole = dict.fromkeys(chain.from_iterable(rows))
        number = dict(zip(whole, range(len(whole)), strict=True))
        sizes = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        return code_points(list(whole)), np.fromiter(map(number.__getitem__, chain.from_iterable(rows)), dtype=np.int64, count=int(sizes.sum())), sizes
    # a word begins with a run of blanks; the blank that the model adds stands before the text
    said = pc.binary_join_element_wise(pa.scalar(" ", said.type), said.filter(pa.array(full)), pa.scalar("", said.type))
    edge = np.frombuffer(said.buffers()[1], dtype=np.int64)[said.offset : said.offset + len(said) + 1]
    data = np.frombuffer(said.buffers()[2], dtype=np.uint8)[edge[0] : edge[-1]]
    blank = data == 32
    fresh = blank.copy()
    fresh[1:] &= ~blank[:-1]
    fresh[edge[:-1] - edge[0]] = True
    vocabulary.cuts(data, fresh)
    begin = np.flatnonzero(fresh)
    coded = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data)).dictionary_encode()
    many = np.zeros(len(texts), dtype=np.int64)
    many[full] = np.diff(np.searchsorted(begin, edge - edge[0]))
    whole = coded.dictionary
    ends = np.frombuffer(whole.buffers()[1], dtype=np.int64)[whole.offset : whole.offset + len(whole) + 1]
    raw = np.frombuffer(whole.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
    sizes = np.add.reduceat((raw & 192) != 128, ends[:-1] - ends[0], dtype=np.int64)  # no part is empty
    chars = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), dtype="<u4").astype(np.int64)
    chars[chars == 32] = ord(BLANK)
    return (chars, sizes), coded.indices.to_numpy(), many


@dataclass
class Lattice:
    """States are (word, position) one after another; edges are sorted by state."""

    first: np.ndarray  # state of each word's start
    edge: np.ndarray  # first edge of each state, and the number of edges at the end
    start: np.ndarray  # state of each edge
    to: np.ndarray  # state that an edge leads to; -1 ends the word
    piece: np.ndarray
    logp: np.ndarray  # conditional log-probability of the edge
    ladder: np.ndarray  # cumulative probability of the state's edges


def lattice(words: list[str], vocabulary: Vocabulary) -> Lattice:
    return lattice_of(*code_points(words), vocabulary)


def lattice_of(chars: np.ndarray, lengths: np.ndarray, vocabulary: Vocabulary) -> Lattice:
    """Lattice of words that are given by ``code_points``."""
    units, sizes = vocabulary.units(chars, lengths)
    n = len(units)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else np.zeros(0, np.int64)
    left = (np.repeat(first + sizes, sizes) - np.arange(n)).astype(np.int32)  # units up to the word's end
    hashed = vocabulary._hash(units)
    found = []
    live, want, ahead = np.arange(n, dtype=np.int32), np.zeros(n, dtype=np.uint64), left
    degree = np.zeros(n, dtype=np.int32)
    with np.errstate(over="ignore"):
        for k in range(1, vocabulary.longest + 1):
            if k > 1:
                go = np.flatnonzero(vocabulary.opens[k - 1][slot] & (ahead >= k))
                live, want, ahead = live[go], want[go], ahead[go]
            if not len(live):
                break
            want = want * _M3 + hashed[live + (k - 1)]
            slot = vocabulary._slot(want)
            if k not in vocabulary.tables:
                continue
            keys, ids = vocabulary.tables[k]
            maybe = np.flatnonzero(vocabulary.sieve[k][slot])
            sought = want[maybe]
            at = np.searchsorted(keys, sought)
            at[at == len(keys)] = 0
            hit = keys[at] == sought
            s = live[maybe[hit]]
            found.append((k, s, ids[at[hit]], degree[s]))
            degree[s] += 1
    # edges by state, shorter pieces first
    edge = np.concatenate([[0], np.cumsum(degree, dtype=np.int64)])
    start = np.repeat(np.arange(n, dtype=np.int32), degree)
    to, piece = np.empty(len(start), dtype=np.int32), np.empty(len(start), dtype=np.int32)
    for k, s, ids, nth in found:
        at = edge[s] + nth
        to[at] = np.where(left[s] == k, -1, s + k)
        piece[at] = ids
    logp = conditional(vocabulary.logp, left, start, to, piece)
    ladder = np.exp(logp)
    at, last = edge[:-1] + 1, edge[1:]
    while len(at):  # a state has few edges
        on = np.flatnonzero(at < last)
        at, last = at[on], last[on]
        ladder[at] += ladder[at - 1]
        at = at + 1
    return Lattice(first, edge, start, to, piece, logp, ladder)


def conditional(weight: np.ndarray, left: np.ndarray, start: np.ndarray, to: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Log-probability of each edge given its state, from the mass of each state to the end of its
    word, by distance from the end: as it is where that is in range, and its logarithm beyond."""
    if not len(start):
        return np.zeros(0)
    far = left[start]
    if far.max() < 1 << 15:
        far = far.astype(np.int16)  # sorted by radix
    by_left = np.argsort(far, kind="stable")
    far, source, target = far[by_left], start[by_left], to[by_left]
    raw = weight[piece[by_left]]
    value = np.exp(raw)
    group = np.concatenate([[0], np.flatnonzero(np.diff(far)) + 1, [len(far)]])
    begin = np.concatenate([[0], np.flatnonzero(np.diff(source)) + 1])  # first edge of each state
    state = np.searchsorted(begin, group)
    # a unit has at most 16 edges, and none weighs less than the least piece
    near = int(np.searchsorted(far, min(200, int(600 / max(1e-9, -float(weight.min())))), side="right"))
    mass = np.zeros(len(left) + 1)
    mass[-1] = 1.0
    own = np.diff(np.append(begin, len(far)))
    out, logs = np.empty(len(far)), None
    for a, b, i, j in zip(group[:-1].tolist(), group[1:].tolist(), state[:-1].tolist(), state[1:].tolist(), strict=True):
        if b <= near:
            value[a:b] *= mass[target[a:b]]
            mass[source[begin[i:j]]] = np.add.reduceat(value[a:b], begin[i:j] - a)
            continue
        if logs is None:
            with np.errstate(divide="ignore"):
                logs = np.log(mass)
        v, at = raw[a:b] + logs[target[a:b]], begin[i:j] - a
        top = np.maximum.reduceat(v, at)
        total = top + np.log(np.add.reduceat(np.exp(v - np.repeat(top, own[i:j])), at))
        logs[source[begin[i:j]]] = total
        value[a:b] = v - np.repeat(total, own[i:j])
    value[:near] /= mass[source[:near]]
    np.log(value[:near], out=value[:near])
    out[by_left] = value
    return out


def draw(lat: Lattice, states: np.ndarray, hashed: np.ndarray, who: np.ndarray):
    """Paths from ``states`` to the ends of their words; ``hashed`` is the seed of each path, and
    ``who`` has the paths in the order in which they are drawn.

    Returns the edges drawn, path after path, and where each path begins (and the end).
    """
    owner, edges, count = [], [], np.zeros(len(states), dtype=np.int64)
    at, h, k = states[who], hashed[who], 0
    while len(who):
        target = uniform(mixed(h, np.int64(k)))
        e, last = lat.edge[at], lat.edge[at + 1] - 1
        on = np.flatnonzero((lat.ladder[e] < target) & (e < last))
        while len(on):  # a state has few edges
            e[on] += 1
            on = on[(lat.ladder[e[on]] < target[on]) & (e[on] < last[on])]
        owner.append(who)
        edges.append(e)
        count[who] += 1
        to = lat.to[e]
        on = np.flatnonzero(to >= 0)
        who, at, h, k = who[on], to[on], h[on], k + 1
    begin = np.concatenate([[0], np.cumsum(count)])
    path = np.empty(begin[-1], dtype=np.int64)
    for k, (w, e) in enumerate(zip(owner, edges, strict=True)):
        path[begin[w] + k] = e
    return path, begin


def loglog(h: np.ndarray) -> np.ndarray:
    """log(-log u) of uniform numbers from hashes: standard Gumbel values with their signs turned."""
    return np.log(-np.log(np.minimum(uniform(h), 1 - 2e-16)))


@dataclass
class Paths:
    """Whole paths, one after another."""

    edges: np.ndarray
    bounds: np.ndarray

    def __getitem__(self, i: int) -> np.ndarray:
        return self.edges[self.bounds[i] : self.bounds[i + 1]]


@dataclass
class Opened:
    """Sets of paths that leave their path first at some edge, or (turn -1) after ``where`` edges;
    those of one path stand together, the largest value first."""

    paths: Paths
    path: np.ndarray  # number of the path
    bounds: np.ndarray  # first set of each path, and the end
    where: np.ndarray  # edges kept of the path
    turn: np.ndarray  # the edge taken then
    location: np.ndarray
    value: np.ndarray
    kept: np.ndarray  # log-probability of the edges kept
    words: np.ndarray  # words that these end


BLOCK = 16


def split(lat: Lattice, paths: Paths, begin, kept, words, top, forced, hashed) -> Opened:
    """Open, for each path, the sets of paths that leave it first at an edge from ``begin`` on.

    ``kept``: log-probability of the path's first ``begin`` edges.  Where ``forced``, the largest
    value of all the sets of a path is ``top`` itself, else every one is below it.
    """
    length = np.diff(paths.bounds)
    stop = np.minimum(length, begin + BLOCK)
    grid = begin[:, None] + np.arange(BLOCK)
    inside = grid < stop[:, None]
    i, j = np.nonzero(inside)
    own = paths.edges[paths.bounds[i] + grid[i, j]]
    total, ended = np.zeros((len(begin), BLOCK + 1)), np.zeros((len(begin), BLOCK + 1), dtype=np.int64)
    total[:, 0], ended[:, 0] = kept, words
    total[i, j + 1], ended[i, j + 1] = lat.logp[own], lat.to[own] < 0
    total, ended = np.cumsum(total, axis=1), np.cumsum(ended, axis=1)
    state = lat.start[own]
    a, many = lat.edge[state], lat.edge[state + 1] - lat.edge[state]
    cell = np.repeat(np.arange(len(own)), many)
    turn = np.repeat(a - (np.cumsum(many) - many), many) + np.arange(len(cell))
    other = turn != own[cell]
    cell, turn = cell[other], turn[other]
    # from ``stop`` on; summed, not subtracted, since it is exactly 0 where a path cannot turn off any more
    rest = np.add.reduceat(np.append(lat.logp[paths.edges], 0.0), np.stack([paths.bounds[:-1] + stop, paths.bounds[1:]], axis=1).ravel())[::2]
    late = np.flatnonzero((stop < length) & (rest < 0))
    beyond = total[late, -1] + np.log(-np.expm1(rest[late]))
    path, column = np.concatenate([i[cell], late]), np.concatenate([j[cell], np.full(len(late), BLOCK)])
    where = np.concatenate([grid[i, j][cell], stop[late]])
    turn = np.concatenate([turn, np.full(len(late), -1)])
    location = np.concatenate([total[i, j][cell] + lat.logp[turn[: len(cell)]], beyond])
    noise = loglog(mixed(hashed[path], column, np.where(turn < 0, -1, turn - lat.edge[lat.start[turn]]))) - location
    value = -np.logaddexp(-top[path], noise)
    if forced.any():
        # move all values so that the largest is ``top``: -log(e^-top + e^-noise - e^-largest)
        largest = np.full(len(begin), np.inf)
        np.minimum.at(largest, path, noise)
        with np.errstate(divide="ignore"):
            moved = top[path] - np.logaddexp(0.0, top[path] + noise + np.log1p(-np.exp(largest[path] - noise)))
        value = np.where(forced[path], moved, value)
    order = np.lexsort((-value, path))
    path, column = path[order], column[order]
    return Opened(paths, path, np.searchsorted(path, np.arange(len(begin) + 1)), where[order], turn[order], location[order],
                  value[order], total[path, column], ended[path, column])


def search(lat: Lattice, free: list[tuple[np.ndarray, np.ndarray]], ends: np.ndarray, hashed: np.ndarray, k: int):
    """(path, log-probability, perturbed value, inclusion) of up to k segmentations of each row.

    ``free`` has the free draws of all words of the rows, ``ends`` how many words there are up to the end of
    each row.  Sample m of a row uses draw m from where its set of paths is free.  All rows take their next
    set at once: what is drawn and opened for them is drawn and opened together.
    """
    n = len(ends)
    found: list[list] = [[] for _ in range(n)]
    heaps: list[list] = [[] for _ in range(n)]
    if not n:
        return []
    begins = np.concatenate([[0], ends[:-1]])
    hashed = mixed(hashed, np.int64(-1))
    edges, at = free[0]
    rows, paths, number = np.arange(n), Paths(edges, at[np.append(begins, ends[-1])]), 0
    zero = np.zeros(n)
    begin, words, kept, forced, top = zero.astype(np.int64), zero.astype(np.int64), zero, zero.astype(bool), -loglog(mixed(hashed, np.int64(0)))
    while len(rows):
        whole = np.add.reduceat(lat.logp[paths.edges], paths.bounds[:-1])
        for i, (r, late, lp, value) in enumerate(zip(rows.tolist(), forced.tolist(), whole.tolist(), top.tolist(), strict=True)):
            if not late:
                found[r].append((paths[i], lp, value))
        number += 1
        opened = split(lat, paths, begin, kept, words, top, forced, mixed(hashed[rows], np.int64(number)))
        first, last = opened.bounds[:-1].tolist(), opened.bounds[1:].tolist()
        value = opened.value.tolist()
        taken = []
        for r, a, b in zip(rows.tolist(), first, last, strict=True):
            heap = heaps[r]
            if a < b:
                heapq.heappush(heap, (-value[a], number, a, b, opened))
            if heap and len(found[r]) < k:
                _, since, a, b, sets = heap[0]
                if a + 1 < b:
                    heapq.heapreplace(heap, (-float(sets.value[a + 1]), since, a + 1, b, sets))
                else:
                    heapq.heappop(heap)
                taken.append((r, a, sets))
        if not taken:
            break
        rows = np.array([r for r, _, _ in taken])
        of = lambda name: np.array([getattr(sets, name)[a] for _, a, sets in taken])
        begin, turn, kept, words, top, place = of("where"), of("turn"), of("kept"), of("words"), of("value"), of("path")
        forced = turn < 0
        location = of("location")
        # the word at hand is drawn to its end, the words after it come from the row's free draw
        leads = np.where(forced, -1, lat.to[turn])
        on = np.flatnonzero(leads >= 0)
        tails, at = draw(lat, leads[on], mixed(hashed[rows[on]], np.int64(-number)), np.arange(len(on)))
        tail = dict(zip(on.tolist(), zip(at[:-1].tolist(), at[1:].tolist(), strict=True), strict=True))
        blocks = []
        for i, ((r, _, sets), late, e, b, w) in enumerate(zip(taken, forced.tolist(), turn.tolist(), begin.tolist(), words.tolist(), strict=True)):
            path = sets.paths[place[i]]
            if late:
                blocks.append((path,))
                continue
            a, z = tail.get(i, (0, 0))
            edges, at = free[len(found[r])]
            blocks.append((path[:b], turn[i : i + 1], tails[a:z], edges[at[begins[r] + w + 1] : at[ends[r]]]))
        sizes = [sum(map(len, x)) for x in blocks]
        paths = Paths(np.concatenate(list(chain.from_iterable(blocks))), np.concatenate([[0], np.cumsum(sizes)]))
        # what a turn keeps is the path up to it and the turn itself
        words = words + (~forced & (lat.to[turn] < 0))
        begin, kept = begin + ~forced, np.where(forced, kept, location)
    out = []
    for r in range(n):
        # the (k+1)-th value: nothing left means that all segmentations are in
        bound = -heaps[r][0][0] if heaps[r] else -math.inf
        out.append([(p, lp, v, -math.expm1(-math.exp(min(lp - bound, 50.0)))) for p, lp, v in found[r]])
    return out


def sample_texts(texts: list[str], keys: list[int], vocabulary: Vocabulary, k: int, seed: int):
    """For each text its samples: (ids, log-probability, perturbed value, inclusion)."""
    whole, flat, many = numbered_parts(texts, vocabulary)
    lat = lattice_of(*whole, vocabulary)
    full = np.flatnonzero(many)
    many = many[full]
    ends = np.cumsum(many)
    place = np.arange(len(flat)) - np.repeat(ends - many, many)
    states = lat.first[flat]
    of_row = mixed(np.uint64(0), np.int64(seed), np.array(keys, dtype=np.int64)[full])
    of_word, who = np.repeat(of_row, many), np.argsort(flat, kind="stable")  # like words together: neighbours in memory
    free = [draw(lat, states, mixed(of_word, np.int64(m), place), who) for m in range(k)]
    out: list[list] = [[(np.zeros(0, dtype=np.int64), 0.0, 0.0, 1.0)] for _ in texts]
    for i, found in zip(full.tolist(), search(lat, free, ends, of_row, k), strict=True):
        out[i] = [(lat.piece[p], lp, v, q) for p, lp, v, q in found]
    return out


def sample_segmentations(docs: DataFrame, model: str, k: int = 2, seed: int = 7, alpha: float = 0.3) -> DataFrame:
    """Up to ``k`` distinct segmentations of each whole text, drawn without replacement.

    Columns: doc_id, sample (from 1, by falling perturbed value), ids (little-endian unsigned 32-bit
    bytes), n_pieces, log_prob, perturbed, inclusion (the probability that the segmentation would be
    among the k, given the next value), decoded_crc32 (of the decoded text) and text_crc32.
    A null text is empty; the empty text has one segmentation, without pieces and sure.  A text with
    fewer segmentations gives all it has.  U+2581 in a text is a blank to the vocabulary and comes back as
    one, so decoded_crc32 is not that of the text.  A long text is searched whole.  Rows that repeat give the same samples, since the row key is
    doc_id; a null doc_id has the key 0.  An empty table gives no rows; other columns are not read.
    """

    @lean
    def run(batches):
        import pyarrow as pa

        worker_for("pieces")
        vocabulary = Vocabulary.load(model, alpha)
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        names = ["doc_id", "sample", "ids", "n_pieces", "log_prob", "perturbed", "inclusion", "decoded_crc32", "text_crc32"]
        for batch in (g for b in batches for g in byte_groups(b)):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: list[list] = [[] for _ in kinds]
            samples = sample_texts(texts, [x or 0 for x in ids], vocabulary, k, seed)
            decoded = iter(vocabulary.decoded_crc32([pieces for found in samples for pieces, *_ in found]))
            for i, text, found in zip(ids, texts, samples, strict=True):
                crc = zlib.crc32(text.encode("utf-8", "surrogatepass"))
                for m, (pieces, lp, value, q) in enumerate(found):
                    for col, v in zip(out, (i, m + 1, pieces.astype("<u4").tobytes(), len(pieces), lp, value, q, next(decoded), crc), strict=True):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, sample int, ids binary, n_pieces long, log_prob double, perturbed double, inclusion double, "
             "decoded_crc32 long, text_crc32 long")
