"""Operator 2: toxicity by a fuzzy lexicon and the context of its hits.

The lexicon is learned: words, and beginnings of words, that toxic documents of the training rows
hold far more often than others.  It is kept as a trie and intersected with Levenshtein automata;
the product is made deterministic as words ask for it, so a word costs one dictionary step a letter
and most words die within a few letters.  Around every hit a context window tells quotation from
abuse.  A logistic model, fitted on training rows that the lexicon has not seen, turns the evidence
into a score.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import byte_groups, give_back, lean, materialize, resolved, small_batches, worker_for

STRIP = "\"'`´“”„«»‹›‘’.,;:!?…()[]{}<>*#$%&_-–—|/\\=+~^"
OPEN = "\"“„«‹‘'"
CLOSE = "\"”“»›’'"
FEATURES = 7


class FuzzyTrie:
    """Terms within ``edits`` Levenshtein edits of a word; terms shorter than ``least`` must match
    exactly, as must the first letter of none."""

    LIMIT = 150_000  # transitions kept before the memory starts anew

    def __init__(self, terms, edits: int = 1, least: int = 5):
        self.edits, self.least = edits, least
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        for t in sorted(terms):
            node = 0
            for ch in t:
                nxt = self.children[node].get(ch)
                if nxt is None:
                    nxt = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.children[node][ch] = nxt
                node = nxt
            self.term[node] = t
        self._reset()

    def _reset(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: dict[tuple[int, str], int] = {}
        self.start = self._state({0: 0})

    def _state(self, front: dict[int, int]) -> int:
        """Number of a set of (node, edits); skipped letters of a term are added here."""
        queue = list(front.items())
        while queue:
            node, used = queue.pop()
            if used < self.edits and front.get(node) == used:
                for nxt in self.children[node].values():
                    if front.get(nxt, 99) > used + 1:
                        front[nxt] = used + 1
                        queue.append((nxt, used + 1))
        key = frozenset(front.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
        return self.states[key]

    def _step(self, state: int, ch: str) -> int:
        front: dict[int, int] = {}
        for node, used in self.sets[state]:
            for c, nxt in self.children[node].items():
                cost = used + (c != ch)
                if cost <= self.edits and cost < front.get(nxt, 99):
                    front[nxt] = cost
            if used < self.edits and used + 1 < front.get(node, 99):
                front[node] = used + 1
        return self._state(front) if front else -1

    def match(self, word: str) -> tuple[str, int] | None:
        """The nearest term (then the first in the alphabet) and its edits; what is remembered of other
        words makes no difference."""
        if len(self.moves) > self.LIMIT:  # between words: a word's own moves stay until it is done
            self._reset()
        state, moves = self.start, self.moves
        for ch in word:
            nxt = moves.get((state, ch))
            if nxt is None:
                nxt = moves[state, ch] = self._step(state, ch)
            if nxt < 0:
                return None
            state = nxt
        found = [(used, t) for node, used in self.sets[state] if (t := self.term[node]) is not None
                 and (used == 0 or len(t) >= self.least)]
        return (min(found)[1], min(found)[0]) if found else None


def tokens(text: str) -> list[str]:
    return text.lower().split()


def word_of(token: str) -> str:
    return token.strip(STRIP)


def beginnings(word: str) -> list[str]:
    """Beginnings that may stand for a family of forms."""
    return [word[:k] + "*" for k in (4, 5, 6) if len(word) > k]


class Model:
    """Words and beginnings of words with their weights, and the logistic weights.

    ``strong`` words leave no doubt and are also found misspelled; ``weak`` ones and the forms of
    ``stems`` count by the number of different ones that a document holds.
    """

    def __init__(self, strong: dict[str, float], weak: dict[str, float], stems: dict[str, float],
                 weights: list[float] | None = None, base: float = 0.0, window: int = 6):
        self.strong, self.weak, self.stems = strong, weak, stems
        self.weights, self.base, self.window = weights, base, window
        self.trie: FuzzyTrie | None = None
        self.known: dict[str, tuple[str, int, float] | None] = {}

    def __getstate__(self):
        return {**self.__dict__, "trie": None, "known": {}}

    def verdict(self, token: str) -> tuple[str, int, float] | None:
        """(term, kind, weight): kind 0 strong, 1 weak or a form of a stem, 2 misspelled."""
        try:
            return self.known[token]
        except KeyError:
            pass
        if self.trie is None:
            self.trie = FuzzyTrie(self.strong)
        word = word_of(token)
        out = (word, 0, self.strong[word]) if word in self.strong else None
        if out is None:
            families = [self.stems[word[:k]] for k in (4, 5, 6) if len(word) > k and word[:k] in self.stems]
            if word in self.weak or families:
                out = (word, 1, max([self.weak.get(word, 0.0), *families]))
            elif len(word) >= 4 and (near := self.trie.match(word)):
                out = (near[0], 2, self.strong[near[0]])
        if len(self.known) > 150_000:
            self.known.clear()
        self.known[token] = out
        return out

    def quoted(self, toks: list[str], i: int) -> float:
        """1 if the hit stands between quotation marks within the window, one half if a colon or
        an opening mark alone leads to it, else 0."""
        left, right = toks[max(0, i - self.window) : i + 1], toks[i : i + 1 + self.window]
        opened = closed = -1
        for k, t in enumerate(left):
            if t[0] in OPEN:
                opened = k
            if k < len(left) - 1 and len(t) > 1 and t.rstrip(".,;:!?…")[-1:] and t.rstrip(".,;:!?…")[-1] in CLOSE:
                closed = k
        ends = any(len(t) > 1 and (s := t.rstrip(".,;:!?…")) and s[-1] in CLOSE for t in right)
        if opened >= 0 and opened > closed and ends:
            return 1.0
        return 0.5 if (opened > closed or (len(left) > 1 and left[-2].endswith(":"))) else 0.0

    def features(self, text: str) -> list[float]:
        toks = tokens(text)
        hits = [(i, v) for i, v in enumerate(map(self.verdict, toks)) if v]
        out = [0.0] * FEATURES
        seen: set[str] = set()
        places = [i for i, _ in hits]
        for n, (i, (term, kind, weight)) in enumerate(hits):
            abuse = 1.0 - self.quoted(toks, i)
            out[3] += 1.0 - abuse
            if n and places[n] - places[n - 1] <= self.window:
                out[4] += abuse
            if term not in seen:
                seen.add(term)
                out[kind] += weight * abuse
        out[5] = 100.0 * len(hits) / (len(toks) + 20)
        out[6] = float(bool(hits))
        return [math.log1p(x) for x in out]

    def score(self, text: str | None) -> float:
        if self.weights is None:
            return self.base
        z = self.weights[-1] + sum(a * b for a, b in zip(self.weights, self.features(text or ""), strict=False))
        return 1.0 / (1.0 + math.exp(-max(-35.0, min(35.0, z))))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 60) -> list[float]:
    """Ridge logistic regression by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    keep = np.eye(x.shape[1]) * ridge
    keep[-1, -1] = 1e-3
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (p - y) + keep @ w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w.tolist()


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def train(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> Model:
    """Fit on rows of ``labels`` (doc_id, toxic) outside the held-out fold 2.

    ``max_rows`` bounds the labelled rows used (those with the smallest hash of doc_id), so what is
    broadcast and gathered is bounded too: a term of the lexicon stands in three toxic texts of the
    sample at least.  Folds 0 and 1 give the lexicon, fold 3 the weights.  Equal texts of a fold are
    one row, toxic if any of them is, so copies tell nothing new and the model does not depend on
    how rows lie in partitions.  Null labels and ids are left out; rows that repeat an id count as
    toxic if any is; without training rows of both kinds the score is the share of toxic ones.
    """
    small_batches(docs.sparkSession)
    picked = (
        labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) != 2)
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy(  # at most max_rows rows of two numbers
        (fold(F.col("doc_id")) == 3).alias("weighs"), F.xxhash64("text").alias("hash")
    ).agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))

    @lean
    def count(batches):
        import pyarrow as pa

        worker_for("toxicity")
        toxic: Counter = Counter()
        clean: Counter = Counter()
        for batch in (g for b in batches for g in byte_groups(b, 0)):
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = {w for w in map(word_of, set(tokens(text or ""))) if 3 <= len(w) <= 40}
                words.update([b for w in words for b in beginnings(w)])
                (toxic if y else clean).update(words)
                toxic["\0"] += bool(y)
                clean["\0"] += not y
        keys = list(toxic.keys() | clean.keys())
        for a in range(0, len(keys), 50_000):
            k = keys[a : a + 50_000]
            yield pa.RecordBatch.from_pydict({
                "term": k, "toxic": pa.array([int(toxic[x]) for x in k], pa.int64()),
                "clean": pa.array([int(clean[x]) for x in k], pa.int64())})

    counts = materialize(rows.where("not weighs").select("text", "toxic").mapInArrow(
        count, "term string, toxic long, clean long").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "terms")
    n_terms = counts.count()
    found = counts.where(
        "term = '\\0' or (toxic >= 3 and toxic >= 4 * clean) or (term like '%*' and toxic >= 5 and 3 * toxic >= clean)"
    ).collect()
    total = {r["term"]: (r["toxic"], r["clean"]) for r in found}
    n_toxic, n_clean = total.pop("\0", (0, 0))
    base = n_toxic / (n_toxic + n_clean) if n_toxic + n_clean else 0.0
    if not n_toxic or not n_clean:
        return Model({}, {}, {}, None, base)
    # so many toxic documents that chance alone is not to give one such term among all terms
    sure = max(3, n_toxic // 100, math.ceil((math.log(n_terms + 1) + 2) / math.log(1 / base)))
    weight = {t: math.log((a + 0.5) / (n_toxic + 1) * (n_clean + 1) / (b + 0.5)) for t, (a, b) in total.items()}
    words = {t: w for t, w in weight.items() if not t.endswith("*") and w > 2}
    model = Model(
        strong={t: w for t, w in words.items() if total[t][0] >= sure},
        weak={t: w for t, w in words.items() if total[t][0] >= max(3, n_toxic // 100)},
        stems={t[:-1]: w for t, w in weight.items() if t.endswith("*") and w > 1.5 and total[t][0] >= sure})

    @lean
    def evidence(batches):
        import pyarrow as pa

        for batch in batches:
            x = [model.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1).cast(pa.int64())], names=["x", "y"])

    held = rows.where("weighs").orderBy("hash").select("text", "toxic").mapInArrow(evidence, "x array<double>, y long").collect()
    y = np.array([r["y"] for r in held], dtype=float)
    if not len(y) or y.min() == y.max():
        model.weights, model.base = [0.5] * FEATURES + [math.log(base / (1 - base)) - 1], base
        return model
    x = np.array([r["x"] for r in held])
    live = np.ones(FEATURES, dtype=bool)
    while True:  # evidence of a hit never speaks against toxicity
        w = np.zeros(FEATURES + 1)
        w[np.r_[live, True]] = logistic(x[:, live], y)
        if not (wrong := (w[:3] < 0)).any():
            break
        live[:3] &= ~wrong
    model.weights = w.tolist()
    model.base = base
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, names: tuple[str, str] = ("toxicity", "toxic")) -> DataFrame:
    """All columns of ``docs`` and, under ``names``, the score (0 to 1) and the verdict (1 from
    ``threshold`` on).

    A null or empty text has no evidence and gets the score of none.  Rows that repeat stay, and
    columns of these two names are replaced.
    """
    small_batches(docs.sparkSession)

    @pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        worker_for("toxicity")
        for texts in batches:
            yield pd.Series([model.score(t) for t in texts], dtype="float64")
        give_back()

    return docs.withColumn(names[0], of(resolved("text"))).withColumn(names[1], (resolved(names[0]) >= threshold).cast("int"))
