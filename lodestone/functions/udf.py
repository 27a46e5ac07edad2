"""Vectoriser and reranker plug-ins: user functions in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Vectorizer(Protocol):
    """What a provider plugs in: texts to vectors of ``dims`` numbers, many at a time."""

    dims: int
    model: str

    def embed_many(self, texts: list[str]) -> list[list[float]]: ...


class CustomVectorizer:
    def __init__(self, embed: Callable[[str], list[float]], embed_many: Callable[[list[str]], list[list[float]]] | None = None, model: str = "custom") -> None:
        self._one, self._many, self.model = embed, embed_many, model
        probe = embed("dimension check")
        if not isinstance(probe, (list, tuple)) or not all(isinstance(x, (int, float)) for x in probe):
            raise ValueError("embed must return a list of numbers")
        self.dims = len(probe)

    def embed(self, text: str, preprocess: Callable[[str], str] | None = None) -> list[float]:
        if not isinstance(text, str):
            raise TypeError("only strings are embedded")
        return [float(x) for x in self._one(preprocess(text) if preprocess else text)]

    def embed_many(self, texts: list[str], batch_size: int = 10, preprocess: Callable[[str], str] | None = None) -> list[list[float]]:
        if not isinstance(texts, list) or not all(isinstance(t, str) for t in texts):
            raise TypeError("a list of strings is needed")
        texts = [preprocess(t) if preprocess else t for t in texts]
        out: list[list[float]] = []
        for at in range(0, len(texts), batch_size):
            part = texts[at : at + batch_size]
            out += self._many(part) if self._many else [self._one(t) for t in part]
        return [[float(x) for x in v] for v in out]


def batchify(items: list, size: int, fn: Callable | None = None) -> Iterator[list]:
    for at in range(0, len(items), size):
        part = items[at : at + size]
        yield [fn(x) for x in part] if fn else part


def embed_column(df: DataFrame, text: str, out: str, vectorizer: Vectorizer) -> DataFrame:
    """``out``: the vector of each text; null for null. The vectoriser is set up once for each task."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in parts:
            known = s.notna()
            vectors = iter(vectorizer.embed_many(s[known].tolist()))
            yield pd.Series([next(vectors) if k else None for k in known], index=s.index)

    return df.withColumn(out, run(text))


def embed_with_cache(df: DataFrame, text: str, out: str, vectorizer: Vectorizer, cache) -> DataFrame:
    """Hits come from the cache by join; each distinct text that is not there is embedded once and stored."""
    asked = df.withColumn("_model", F.lit(vectorizer.model))
    missing = cache.mget(asked.select(F.col(text).alias("content"), F.col("_model").alias("model_name")).where(F.col("content").isNotNull()).distinct()).where(F.col("embedding").isNull())
    fresh = embed_column(missing.select("content", "model_name"), "content", "embedding", vectorizer)
    cache.mset(fresh)
    found = cache.index.df.where(F.col("model_name") == vectorizer.model).select(F.col("content").alias(text), F.col("embedding").alias(out))
    return df.join(found, text, "left")


def rerank(df: DataFrame, query: str, content: str, scorer: Callable[[str, list[str]], list[float]], limit: int = 5, return_score: bool = True) -> DataFrame:
    """The ``limit`` rows of highest score for ``query``; ``scorer`` takes the query and a batch of texts."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(scorer(query, s.fillna("").tolist()), index=s.index)

    if content not in df.columns:
        raise ValueError(f"documents need a column {content!r}")
    out = df.withColumn("score", run(content)).orderBy(F.col("score").desc(), content).limit(limit)
    return out if return_score else out.drop("score")


def overlap_scorer(query: str, texts: list[str]) -> list[float]:
    """A model-free scorer: the share of the query's words that a text holds."""
    words = set(query.lower().split())
    return [len(words & set(t.lower().split())) / max(1, len(words)) for t in texts]


def provider(name: str, **_: Any) -> Vectorizer:
    """Network providers are plugged in by the user; none is bundled."""
    raise NotImplementedError(f"no vectoriser {name!r} is bundled: wrap a client in CustomVectorizer")
