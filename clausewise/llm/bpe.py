"""Byte-level BPE with the tokenizers library, for whole Arrow arrays of texts.

The pre-tokenizer of a byte-level BPE never lets a token run from a non-space character into the
white space after it, so a text may be cut there and every part encoded alone with the same ids.
Words repeat, so Arrow cuts the texts and numbers their different parts.  These are cut further
where the pre-tokenizer cuts (between letters, digits and marks; the library is asked once for each
character which it is) and merged all together: every round merges the pair of the lowest rank in
each piece, with the ranks of the library's model, on arrays.  Whatever has rules of its own
(contractions, special tokens, odd white space) goes to the library itself, and so does every text
if the file has another pre-tokenizer or model.  Nothing is kept from one call to the next.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np

from .common import KEPT, worker_for

#: what a part begins with: a blank, a line break, or one of these marks
WORD = "\x01"  # this part has no blank before it
RAW = "\x02"  # this part stands with its own white space

_SPACE = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: texts that are cut in Python: white space that does not stand alone, or the marks above (RE2)
_ODD = rf"{_SPACE}{_SPACE}|[\x00-\x02]| \z"
_PARTS = re.compile(r"\s*\S+|\s+")
_PLAIN = re.compile(r" [^\s\x00-\x02]+\Z")
_LOADED: dict[str, "ByteBpe"] = {}
NONE = np.int32(2**31 - 1)
LETTER, DIGIT, SIGN, ODD, BLANK, MARK = 1, 2, 3, 4, 5, 6


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Merges:
    """Rank and result of every pair that the model merges, as a hash table in arrays."""

    SLOTS = 1 << 18

    def __init__(self, model: dict):
        vocab = model["vocab"]
        self.first = np.array([vocab[c] for c in byte_letters()], dtype=np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        self.right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        keys = self.left << 32 | self.right
        rest, self.levels = np.arange(len(keys)), []
        while len(rest):  # what finds its place taken goes to the next table
            salt = np.uint64(0x9E3779B97F4A7C15 + 2 * len(self.levels))
            at = self._slot(keys[rest], salt)
            table = np.full(self.SLOTS, -1, dtype=np.int64)
            rank = np.full(self.SLOTS, NONE, dtype=np.int32)
            table[at[::-1]], rank[at[::-1]] = keys[rest][::-1], rest[::-1]
            placed = table[at] == keys[rest]
            self.levels.append((salt, table, rank))
            rest = rest[~placed]

    def _slot(self, keys: np.ndarray, salt: np.uint64) -> np.ndarray:
        return ((keys.view(np.uint64) * salt) >> np.uint64(46)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where the model does not merge it."""
        keys = left.astype(np.int64) << 32 | right
        salt, table, ranks = self.levels[0]
        at = self._slot(keys, salt)
        out = np.where(table[at] == keys, ranks[at], NONE)
        for salt, table, ranks in self.levels[1:]:
            open_ = np.flatnonzero(out == NONE)
            at = self._slot(keys[open_], salt)
            out[open_] = np.where(table[at] == keys[open_], ranks[at], NONE)
        return out

    def apply(self, token: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens and their pieces after all merges; ``piece`` ascends over the tokens."""
        done_t, done_p = [], []
        token = token.copy()
        rank = np.full(len(token), NONE, dtype=np.int32)  # of a token with the one after it
        inner = np.flatnonzero(piece[1:] == piece[:-1])
        rank[inner] = self.rank(token[inner], token[inner + 1])
        while len(token):
            begin = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
            size = np.diff(np.r_[begin, len(token)])
            least = np.repeat(np.minimum.reduceat(rank, begin), size)
            live = least != NONE
            if not live.all():
                done_t.append(token[~live])
                done_p.append(piece[~live])
                token, piece, rank, least = token[live], piece[live], rank[live], least[live]
                if not len(token):
                    break
            at = np.flatnonzero(rank == least)
            # neighbours of equal rank overlap (a run of one token): every other one, from the left
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            if len(starts) < len(at):
                nth = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
                at = at[nth % 2 == 0]
            token[at] = self.result[rank[at]]
            keep = np.ones(len(token), dtype=bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            token, piece, rank = token[keep], piece[keep], rank[keep]
            new = place[at]
            for again in (new, new[new > 0] - 1):
                last = again + 1 >= len(token)
                nxt = np.where(last, again, again + 1)
                same = (piece[nxt] == piece[again]) & ~last
                rank[again] = NONE
                rank[again[same]] = self.rank(token[again[same]], token[nxt[same]])
        if not done_t:
            return token, piece
        token, piece = np.concatenate(done_t), np.concatenate(done_p)
        order = np.argsort(piece, kind="stable")
        return token[order], piece[order]


class ByteBpe:
    """``encode`` gives the ids of all texts one after another, and where each text's begin."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        said = json.loads(self.tokenizer.to_str())
        pre, model = said.get("pre_tokenizer") or {}, said.get("model") or {}
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: whether parts may be encoded alone
        self.parted = (
            pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not said.get("normalizer")
            and model.get("type") == "BPE" and not any(re.search(r"\s|[\x00-\x02]", a) for a in added)
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        if self.parted:
            self.own_rules = "|".join([r"\A[\x02\n]", *map(re.escape, ["'", *added])])
            self.merges = Merges(model)
            self.kind = np.zeros(0x110000, dtype=np.uint8)  # 0: not asked yet
            self.kind[[1, 32]] = MARK, BLANK

    @classmethod
    def load(cls, path: str) -> "ByteBpe":
        """One encoder for each Python worker and file."""
        worker_for("bpe")
        if path not in _LOADED:
            _LOADED[path] = cls(path)
        KEPT["bpe"] = _LOADED.clear
        return _LOADED[path]

    def _kinds(self, codes: np.ndarray) -> np.ndarray:
        kinds = self.kind[codes]
        if not kinds.all():
            cut = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for code in np.unique(codes[kinds == 0]).tolist():
                mates = ((LETTER, "a"), (DIGIT, "1"), (SIGN, "!"))
                self.kind[code] = next((k for k, mate in mates if len(cut(mate + chr(code))) == 1), ODD)
            kinds = self.kind[codes]
        return kinds

    def _merged(self, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the parts that begin at ``begin`` of the UTF-8 ``data``, the number of each
        part's, and which parts hold white space and must go to the library."""
        lead = (data & 0xC0) != 0x80
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype="<u4")
        kinds = self._kinds(codes)
        first = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(lead, out=first[1:])
        first = first[begin]  # in characters
        # a piece begins with a part and where the kind changes; a blank goes with what follows it
        fresh = np.zeros(len(codes), dtype=bool)
        fresh[1:] = (kinds[1:] != kinds[:-1]) & (kinds[:-1] != BLANK) & (kinds[:-1] != MARK)
        fresh[first] = True
        opens = np.zeros(len(codes), dtype=np.int32)
        opens[first] = 1
        owner = np.cumsum(opens, dtype=np.int32) - 1
        odd = np.unique(owner[kinds == ODD])
        of = owner[fresh]
        at = np.zeros(len(data), dtype=np.int32)
        at[lead] = fresh
        keep = data != 1
        token, piece = self.merges.apply(self.merges.first[data[keep]], (np.cumsum(at, dtype=np.int32) - 1)[keep])
        return token, np.bincount(of[piece], minlength=len(begin)), odd

    def _ids(self, parts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different parts (an Arrow array without nulls), and where each part's begin."""
        import pyarrow.compute as pc

        n = len(parts)
        own = pc.match_substring_regex(parts, self.own_rules).to_numpy(zero_copy_only=False)
        count = np.zeros(n, dtype=np.int64)
        plain, token, many = np.flatnonzero(own), np.zeros(0, dtype=np.int32), count[:0]
        rest = np.flatnonzero(~own)
        if len(rest):
            some = parts.take(rest) if len(plain) else parts
            bounds = np.frombuffer(some.buffers()[1], dtype=np.int64 if "large" in str(some.type) else np.int32)[some.offset : some.offset + len(some) + 1].astype(np.int64)
            data = np.frombuffer(some.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
            token, many, odd = self._merged(data, bounds[:-1] - bounds[0])
            plain = np.union1d(plain, rest[odd])
            count[rest] = many
        if not len(plain):
            return token.astype("<u4"), np.concatenate([[0], np.cumsum(count)])
        said = [p[1:] if p[0] <= RAW else p for p in parts.take(plain).to_pylist()]
        done = [e.ids for e in self.tokenizer.encode_batch_fast(said, add_special_tokens=False)]
        owner = np.repeat(rest, many)
        keep = ~np.isin(owner, plain)
        lengths = np.fromiter(map(len, done), dtype=np.int64, count=len(done))
        count[plain] = lengths
        token = np.concatenate([token[keep], np.fromiter((i for ids in done for i in ids), dtype=np.int32, count=int(lengths.sum()))])
        order = np.argsort(np.concatenate([owner[keep], np.repeat(plain, lengths)]), kind="stable")
        return token[order].astype("<u4"), np.concatenate([[0], np.cumsum(count)])

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """``texts``: Arrow array of strings without nulls, or a list. Ids (unsigned 32-bit) and
        n + 1 bounds."""
        import pyarrow as pa
        import pyarrow.compute as pc

        texts = texts.cast(pa.large_string()) if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        if not self.parted:
            done = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in done])]).astype(np.int64)
            return np.fromiter((i for ids in done for i in ids), dtype="<u4", count=int(bounds[-1])), bounds
        strange = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        some = texts.filter(pa.array(~strange)) if strange.any() else texts
        marked = pc.binary_join_element_wise(*[x if x is some else pa.scalar(x, some.type) for x in (WORD, some, "")])
        marked = pc.replace_substring(pc.replace_substring(marked, " ", "\0 "), "\n", f"\0\n\0{WORD}")
        cut = pc.split_pattern(marked, "\0")
        parts, many = cut.flatten(), np.diff(cut.offsets.to_numpy())
        if strange.any():
            lists = [[p if _PLAIN.match(p) else RAW + p for p in _PARTS.findall(t)]
                     for t in texts.filter(pa.array(strange)).to_pylist()]
            parts = pa.concat_arrays([parts, pa.array([p for x in lists for p in x], parts.type)])
            order = np.concatenate([np.flatnonzero(~strange), np.flatnonzero(strange)])
            many = np.concatenate([many, [len(x) for x in lists]]).astype(np.int64)
        coded = parts.dictionary_encode()
        ids, bounds = self._ids(coded.dictionary)
        which = coded.indices.to_numpy()
        size = np.diff(bounds)[which]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat(bounds[which] - (ends - size), size) + np.arange(total)]
        edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(many)])]
        if not strange.any():
            return out, edge
        # texts back in their order
        length, start = np.empty(len(order), dtype=np.int64), np.empty(len(order), dtype=np.int64)
        length[order], start[order] = np.diff(edge), edge[:-1]
        ends = np.cumsum(length)
        return out[np.repeat(start - (ends - length), length) + np.arange(total)], np.concatenate([[0], ends])
