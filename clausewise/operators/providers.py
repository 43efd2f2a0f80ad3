"""Models and language models behind small interfaces, with deterministic stand-ins.

The stand-ins verify the plumbing; they do not reproduce the numbers of any trained model.
"""

from __future__ import annotations

import math
import re
import time
import zlib
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf


class Sentiment(Protocol):
    def predict(self, texts: list[str]) -> list[tuple[str, float]]: ...


class LexiconSentiment:
    """Stars from a word list; the score grows with the share of words that speak."""

    POSITIVE = frozenset("good great beautiful amazing lovely friendly excellent perfect clean nice".split())
    NEGATIVE = frozenset("bad dirty rude terrible awful overpriced crowded broken poor unsafe".split())

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out = []
        for t in texts:
            words = re.findall(r"\w+", t.lower())
            up, down = sum(w in self.POSITIVE for w in words), sum(w in self.NEGATIVE for w in words)
            stars = 3 + max(-2, min(2, up - down))
            out.append((f"{stars} stars", 0.5 + 0.5 * abs(up - down) / max(1, up + down) if up + down else 0.5))
        return out


class HashEmbedding:
    """Unit vectors from hashed words."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def encode(self, texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * self.dim
            for w in re.findall(r"\w+", t.lower()):
                h = zlib.crc32(w.encode())
                v[h % self.dim] += 1.0 if h >> 16 & 1 else -1.0
            n = math.sqrt(sum(x * x for x in v)) or 1.0
            out.append([x / n for x in v])
        return out


def with_sentiment(df: DataFrame, provider: Sentiment, text: str = "text", batch: int = 32) -> DataFrame:
    """label and score of each row; the provider travels to each worker once and gets batches."""

    @pandas_udf("label string, score double")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for s in parts:
            texts = s.fillna("").tolist()
            got = [x for a in range(0, len(texts), batch) for x in provider.predict(texts[a : a + batch])]
            yield pd.DataFrame(got, columns=["label", "score"])

    return df.withColumn("__s", of.asNondeterministic()(F.col(text))).select("*", "__s.label", "__s.score").drop("__s")


def with_embedding(df: DataFrame, provider, text: str = "text", batch: int = 64) -> DataFrame:
    @pandas_udf("array<float>")
    def of(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            texts = s.fillna("").tolist()
            yield pd.Series([v for a in range(0, len(texts), batch) for v in provider.encode(texts[a : a + batch])])

    return df.withColumn("embedding", of.asNondeterministic()(F.col(text)))


def call(provider: Callable[[str], str], prompt: str, attempts: int = 3, pause: float = 2.0) -> str:
    """The reply; failures are tried again after a growing pause, the last one is raised."""
    for n in range(1, attempts + 1):
        try:
            return provider(prompt)
        except Exception:
            if n == attempts:
                raise
            time.sleep(pause * n)
    raise AssertionError


def with_reply(df: DataFrame, provider: Callable[[str], str], prompt: str = "prompt", tasks: int = 8, attempts: int = 3,
               pause: float = 2.0) -> DataFrame:
    """reply and error of each row; ``tasks`` bounds the calls that run at once.  Materialize the
    result before use, so that Catalyst never repeats a paid call."""
    schema = df.schema.add("reply", "string").add("error", "string")

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            replies, errors = [], []
            for p in part[prompt]:
                try:
                    replies.append(call(provider, p, attempts, pause))
                    errors.append(None)
                except Exception as e:
                    replies.append(None)
                    errors.append(str(e))
            yield part.assign(reply=replies, error=errors)

    return df.repartition(tasks).mapInPandas(run, schema)


def http_chat(url: str, model: str, key: str, temperature: float = 0.0, timeout: float = 120.0) -> Callable[[str], str]:
    """A chat completion endpoint as a provider; the standard library is enough."""

    def ask(prompt: str) -> str:
        import json
        import urllib.request

        body = {"model": model, "temperature": temperature, "messages": [{"role": "user", "content": prompt}]}
        request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {key}"})
        with urllib.request.urlopen(request, timeout=timeout) as r:
            return json.loads(r.read())["choices"][0]["message"]["content"]

    return ask
