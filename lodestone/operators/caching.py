"""Semantic cache and embedding cache over DataFrames."""

from __future__ import annotations

import hashlib
import json
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.operators.filters import Filter
from lodestone.operators.index import EXPIRES, SearchIndex
from lodestone.operators.search import VectorRangeQuery, batch_knn
from lodestone.schema import IndexSchema

#: Columns of a cache table that filterable fields may not take (fixed values).
RESERVED = {"entry_id", "prompt", "response", "prompt_vector", "inserted_at", "updated_at", "metadata", "key"}


def entry_id(prompt: str, filters: dict[str, Any] | None = None) -> str:
    return hashlib.sha256((prompt + "".join(f"{k}{v}" for k, v in sorted((filters or {}).items()))).encode()).hexdigest()


def entry_id_column(prompt: Column, filters: list[tuple[str, Column]] = ()) -> Column:
    parts = [x for k, c in sorted(filters, key=lambda p: p[0]) for x in (F.lit(k), c.cast("string"))]
    return F.sha2(F.concat(prompt, *parts), 256)


def cache_schema(name: str, dims: int, filterable: list[dict[str, Any]] | None = None) -> IndexSchema:
    base = [
        {"name": "prompt", "type": "text"}, {"name": "response", "type": "text"}, {"name": "inserted_at", "type": "numeric"}, {"name": "updated_at", "type": "numeric"},
        {"name": "prompt_vector", "type": "vector", "attrs": {"dims": dims, "distance_metric": "cosine"}},
    ]
    for f in filterable or []:
        if f["name"] in RESERVED:
            raise ValueError(f"{f['name']} is reserved")
    return IndexSchema.from_dict({"index": {"name": name, "prefix": name}, "fields": base + list(filterable or [])})


class SemanticCache:
    """Answers by nearness of the prompt. ``check`` refreshes the time to live of what it hits."""

    def __init__(self, index: SearchIndex, distance_threshold: float = 0.1, ttl: int | None = None) -> None:
        self.index, self.ttl = index, ttl
        self.set_threshold(distance_threshold)

    def set_threshold(self, t: float) -> None:
        if not 0 <= float(t) <= 2:
            raise ValueError("the threshold lies between 0 and 2")
        self.distance_threshold = float(t)

    def set_ttl(self, ttl: int | None) -> None:
        if ttl is not None and (isinstance(ttl, bool) or not isinstance(ttl, int)):
            raise ValueError("ttl is a whole number of seconds")
        self.ttl = ttl

    def lookup(self, vector: list[float], num_results: int = 1, filter: Filter | str | None = None, distance_threshold: float | None = None) -> DataFrame:
        t = self.distance_threshold if distance_threshold is None else distance_threshold
        return self.index.query(VectorRangeQuery(filter=filter, num_results=num_results, vector=vector, field_name="prompt_vector", distance_threshold=t))

    def check(self, vector: list[float], num_results: int = 1, filter: Filter | str | None = None, distance_threshold: float | None = None) -> list[dict[str, Any]]:
        rows = [r.asDict() for r in self.lookup(vector, num_results, filter, distance_threshold).collect()]
        if rows and self.ttl is not None:
            self.index.expire_keys([r[self.index.key] for r in rows], self.ttl)
        return rows

    def check_batch(self, queries: DataFrame, query_id: str, vector: str, num_results: int = 1, distance_threshold: float | None = None) -> DataFrame:
        """``query_id, key, distance, rank`` for a table of prompts at once."""
        t = self.distance_threshold if distance_threshold is None else distance_threshold
        dims = self.index.schema.fields["prompt_vector"].dims
        return batch_knn(self.index.df, self.index.key, "prompt_vector", queries, query_id, vector, dims, num_results, "cosine", t)

    def store(self, prompt: str, response: str, vector: list[float], metadata: dict | None = None, filters: dict[str, Any] | None = None, ttl: int | None = None, now: float = 0.0) -> str:
        ident = entry_id(prompt, filters)
        row = {self.index.key: ident, "prompt": prompt, "response": response, "prompt_vector": [float(x) for x in vector], "inserted_at": now, "updated_at": now, "metadata": json.dumps(metadata) if metadata is not None else "", **(filters or {})}
        self.index.load([row], ttl=self.ttl if ttl is None else ttl)
        return ident

    def update(self, ident: str, now: float = 0.0, **values: Any) -> None:
        unknown = set(values) - set(self.index._raw().columns)
        if unknown:
            raise ValueError(f"unknown fields: {sorted(unknown)}")
        if "metadata" in values and not isinstance(values["metadata"], str):
            values["metadata"] = json.dumps(values["metadata"])
        raw = self.index._raw()
        hit = F.col(self.index.key) == ident
        for k, v in {**values, "updated_at": now}.items():
            raw = raw.withColumn(k, F.when(hit, F.lit(v).cast(raw.schema[k].dataType)).otherwise(F.col(k)))
        self.index._set(raw)
        if self.ttl is not None:
            self.index.expire_keys(ident, self.ttl)

    def drop(self, ids: list[str] | None = None) -> int:
        return self.index.drop_keys(ids or [])

    def clear(self) -> int:
        return self.index.clear()

    def delete(self) -> None:
        self.index.delete(drop=True)


def service_similarity(distance: float, half: bool = False) -> float:
    """The similarity threshold that a remote cache service takes for a cosine distance."""
    return (2.0 - distance) / 2.0 if half else 1.0 - distance


def embedding_key(content: str | bytes, model: str) -> str:
    text = content.hex() if isinstance(content, bytes) else content
    return hashlib.sha256(f"{text}:{model}".encode()).hexdigest()


class EmbeddingsCache:
    """Exact lookups by the hash of content and model, one or many at a time; all are equi-joins on the hash."""

    SCHEMA = "entry_id string, content string, model_name string, embedding array<float>, metadata string"

    def __init__(self, df: DataFrame, ttl: int | None = None) -> None:
        index = SearchIndex(IndexSchema.from_dict({"index": {"name": "embeddings_cache"}, "fields": [{"name": "content", "type": "text"}]}), df, "entry_id")
        self.index, self.ttl = index, ttl

    @staticmethod
    def key_column(content: Column, model: Column) -> Column:
        return F.sha2(F.concat(content, F.lit(":"), model), 256)

    def mget(self, wanted: DataFrame, content: str = "content", model: str = "model_name") -> DataFrame:
        """``wanted`` with ``embedding`` and ``metadata``; null where the cache has none. With a ttl what is found lives on from now."""
        self.refresh(wanted, content, model)
        keyed = wanted.withColumn("entry_id", self.key_column(F.col(content), F.col(model)))
        return keyed.join(self.index.df.select("entry_id", "embedding", F.col("metadata").alias("cached_metadata")), "entry_id", "left")

    def refresh(self, wanted: DataFrame, content: str = "content", model: str = "model_name") -> int:
        """Starts the ttl of the entries of ``wanted`` anew; their number."""
        return self.index.expire_rows(wanted.select(self.key_column(F.col(content), F.col(model)).alias("entry_id")).distinct(), self.ttl) if self.ttl is not None else 0

    def mget_by_keys(self, keys: list[str]) -> list[dict[str, Any] | None]:
        """Entries in the order of ``keys``, None where there is none."""
        wanted = self.index.df.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(keys)], "entry_id string")
        found = {r["entry_id"]: r.asDict() for r in self.index.df.join(wanted, "entry_id", "left_semi").collect()}
        if self.ttl is not None and found:
            self.index.expire_keys(list(found), self.ttl)
        return [found.get(k) for k in keys]

    def mexists_by_keys(self, keys: list[str]) -> list[bool]:
        wanted = self.index.df.sparkSession.createDataFrame([(k,) for k in dict.fromkeys(keys)], "entry_id string")
        found = {r["entry_id"] for r in self.index.df.join(wanted, "entry_id", "left_semi").select("entry_id").collect()}
        return [k in found for k in keys]

    def mdrop_by_keys(self, keys: list[str]) -> int:
        return self.index.drop_keys(keys)

    def mexists(self, wanted: DataFrame, content: str = "content", model: str = "model_name") -> DataFrame:
        keyed = wanted.withColumn("entry_id", self.key_column(F.col(content), F.col(model)))
        return keyed.join(self.index.df.select("entry_id", F.lit(True).alias("found")), "entry_id", "left").withColumn("found", F.coalesce("found", F.lit(False)))

    def mset(self, rows: DataFrame) -> int:
        new = rows.withColumn("entry_id", self.key_column(F.col("content"), F.col("model_name"))).dropDuplicates(["entry_id"])
        if "metadata" not in new.columns:
            new = new.withColumn("metadata", F.lit(None).cast("string"))
        return self.index.load(new.select("entry_id", "content", "model_name", "embedding", "metadata"), ttl=self.ttl)

    def mdrop(self, wanted: DataFrame, content: str = "content", model: str = "model_name") -> None:
        keyed = wanted.select(self.key_column(F.col(content), F.col(model)).alias("entry_id"))
        self.index._set(self.index._raw().join(keyed, "entry_id", "left_anti"), gone=keyed.distinct())

    def get(self, content: str | bytes, model: str) -> dict[str, Any] | None:
        return self.get_by_key(embedding_key(content, model))

    def get_by_key(self, key: str) -> dict[str, Any] | None:
        row = self.index.df.where(F.col("entry_id") == key).head()
        if row is not None and self.ttl is not None:
            self.index.expire_keys(key, self.ttl)
        return row.asDict() if row else None

    def exists(self, content: str | bytes, model: str) -> bool:
        return not self.index.df.where(F.col("entry_id") == embedding_key(content, model)).isEmpty()

    def drop(self, content: str | bytes, model: str) -> int:
        return self.index.drop_keys(embedding_key(content, model))

    def clear(self) -> int:
        return self.index.clear()


__all__ = ["EXPIRES", "EmbeddingsCache", "SemanticCache", "cache_schema", "embedding_key", "entry_id", "entry_id_column", "service_similarity"]
