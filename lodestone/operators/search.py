"""Query objects over a typed DataFrame: filter, count, nearest neighbours, range, text, hybrid, multi-vector.

Every query compiles to one lazy plan. Top-k ends in ``TakeOrderedAndProject`` (a heap for each task and one
merge); only full-text statistics, one row of numbers, are gathered before.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lodestone.functions import text as X
from lodestone.functions import vectors as V
from lodestone.operators.filters import Context, Filter, as_filter
from lodestone.schema import IndexSchema

#: A batch search sends its query vectors to every task; beyond this size it is split into rounds.
BATCH_QUERIES = 4096
#: Queries of a round that are multiplied with an Arrow batch at once: 20 MB of products with 10,000 rows.
TILE_QUERIES = 256
#: A task of a batch search cuts its running lists back to the k best after so many rows.
KEPT_ROWS = 200_000


@dataclass
class Source:
    """A DataFrame with its schema and the unique column that breaks ties."""

    df: DataFrame
    schema: IndexSchema
    key: str
    #: Approximate indices of vector fields, by name; see ``ann.CellIndex``.
    ann: dict[str, Any] = field(default_factory=dict)

    @property
    def dtypes(self) -> dict[str, T.DataType]:
        return {f.name: f.dataType for f in self.df.schema.fields}

    def where(self, f: Filter | str | None) -> DataFrame:
        f = as_filter(f)
        return self.df if f.all else self.df.where(f.compile(Context(self.schema, self.dtypes)))

    def metric(self, name: str) -> str:
        f = self.schema.fields.get(name)
        return f.distance_metric if f else "cosine"

    def check_vector(self, name: str, vector: list[float]) -> None:
        f = self.schema.fields.get(name)
        if f is not None and f.type != "vector":
            raise ValueError(f"{name} is no vector field")
        if f is not None and len(vector) != f.dims:
            raise ValueError(f"{name} has {f.dims} dimensions, the query {len(vector)}")


@dataclass
class Query:
    filter: Filter | str | None = None
    return_fields: list[str] | None = None
    num_results: int = 10
    sort_by: Any = None
    in_order: bool = False

    def _sort(self, df: DataFrame, key: str) -> DataFrame:
        keys = sort_keys(self.sort_by)
        if not keys:
            return df
        if len(keys) > 1:
            warnings.warn("only the first sort key counts", UserWarning, stacklevel=3)
        name, asc = keys[0]
        return df.orderBy(F.col(name).asc() if asc else F.col(name).desc(), F.col(key))

    def _project(self, df: DataFrame, key: str, extra: list[str]) -> DataFrame:
        if self.return_fields is None:
            return df
        return df.select(*dict.fromkeys([key, *self.return_fields, *extra]))


def sort_keys(spec: Any) -> list[tuple[str, bool]]:
    """``"f"``, ``("f", "DESC")`` or a list of either -> (name, ascending)."""
    if spec is None:
        return []
    items = spec if isinstance(spec, list) else [spec]
    out = []
    for i in items:
        if isinstance(i, str):
            out.append((i, True))
        elif isinstance(i, tuple) and len(i) == 2 and isinstance(i[0], str) and str(i[1]).upper() in ("ASC", "DESC"):
            out.append((i[0], str(i[1]).upper() == "ASC"))
        else:
            raise ValueError(f"not a sort key: {i!r}")
    return out


@dataclass
class FilterQuery(Query):
    def run(self, s: Source) -> DataFrame:
        df = self._sort(s.where(self.filter), s.key)
        return self._project(df.limit(self.num_results), s.key, [])


@dataclass
class CountQuery:
    filter: Filter | str | None = None

    def run(self, s: Source) -> DataFrame:
        return s.where(self.filter).agg(F.count("*").alias("count"))


@dataclass
class ApproximateOptions:
    """Knobs of approximate search. They are validated; on a field with a built index ``ef_runtime`` and ``search_window_size`` say how
    many cells are read, an exact scan ignores them."""

    hybrid_policy: str | None = None
    batch_size: int | None = None
    ef_runtime: int | None = None
    search_window_size: int | None = None
    use_search_history: str | None = None
    search_buffer_capacity: int | None = None
    epsilon: float | None = None

    def validate(self, algorithm: str | None) -> None:
        if self.hybrid_policy is not None and self.hybrid_policy not in ("BATCHES", "ADHOC_BF"):
            raise ValueError("hybrid_policy is BATCHES or ADHOC_BF")
        if self.use_search_history is not None and self.use_search_history not in ("OFF", "ON", "AUTO"):
            raise ValueError("use_search_history is OFF, ON or AUTO")
        for name in ("batch_size", "ef_runtime", "search_window_size", "search_buffer_capacity"):
            v = getattr(self, name)
            if v is not None and (isinstance(v, bool) or not isinstance(v, int) or v < 1):
                raise ValueError(f"{name} must be a positive integer")
        if self.epsilon is not None and (isinstance(self.epsilon, bool) or not isinstance(self.epsilon, (int, float)) or self.epsilon < 0):
            raise ValueError("epsilon must not be negative")
        if self.ef_runtime is not None and algorithm not in (None, "hnsw"):
            raise ValueError("ef_runtime applies to hnsw fields only")


@dataclass
class VectorQuery(Query):
    """The ``num_results`` nearest of the rows that pass the filter; a sort reorders them, it never changes which they are."""

    vector: list[float] = field(default_factory=list)
    field_name: str = ""
    normalize: bool = False
    return_score: bool = True
    options: ApproximateOptions = field(default_factory=ApproximateOptions)

    def scored(self, s: Source) -> DataFrame:
        s.check_vector(self.field_name, self.vector)
        f = s.schema.fields.get(self.field_name)
        self.options.validate(f.algorithm if f else None)
        d = V.distance(s.metric(self.field_name), F.col(self.field_name), [float(x) for x in self.vector])
        cells = s.ann.get(self.field_name)
        if cells is not None and type(self) is VectorQuery and f.algorithm != "flat" and s.metric(self.field_name) == "cosine":
            # a hnsw or svs field with a built index: only the cells that the knobs allow are read
            near = cells.near([float(x) for x in self.vector], cells.probes(self.options.ef_runtime or self.options.search_window_size or self.num_results))
            s = replace(s, df=near)
        return s.where(self.filter).withColumn("vector_distance", d).where(F.col("vector_distance").isNotNull())

    def finish(self, s: Source, df: DataFrame) -> DataFrame:
        top = df.orderBy("vector_distance", s.key).limit(self.num_results)
        if self.normalize:
            top = top.withColumn("vector_distance", V.normalised(s.metric(self.field_name), F.col("vector_distance")))
        out = self._project(self._sort(top, s.key), s.key, ["vector_distance"] if self.return_score else [])
        return out if self.return_score or self.return_fields else out.drop("vector_distance")

    def run(self, s: Source) -> DataFrame:
        return self.finish(s, self.scored(s))


@dataclass
class VectorRangeQuery(VectorQuery):
    """Rows within ``distance_threshold`` (inclusive), at most ``num_results``. A normalised threshold is a similarity,
    turned into a distance by the cosine formula whatever the metric."""

    distance_threshold: float = 0.2

    def run(self, s: Source) -> DataFrame:
        t = V.denorm_cosine(self.distance_threshold) if self.normalize else self.distance_threshold
        if t < 0:
            raise ValueError("distance_threshold must not be negative")
        return self.finish(s, self.scored(s).where(F.col("vector_distance") <= F.lit(float(t))))


RangeQuery = VectorRangeQuery


@dataclass
class TextQuery(Query):
    """Rows that hold at least one of the words, by relevance. ``fields``: a name, or weights of several."""

    text: str = ""
    fields: str | dict[str, float] = ""
    scorer: str = "BM25STD"
    stopwords: Any = "english"
    text_weights: dict[str, float] | None = None
    return_score: bool = True
    name: str = "score"

    def weights(self) -> dict[str, float]:
        w = {self.fields: 1.0} if isinstance(self.fields, str) else dict(self.fields)
        if not w or not all(w):
            raise ValueError("a text field is needed")
        for k, v in w.items():
            if isinstance(v, bool) or not isinstance(v, (int, float)) or v <= 0:
                raise ValueError(f"the weight of field {k} must be positive")
        return w

    def terms(self, spark) -> list[str]:
        check_word_weights(self.text_weights)
        return X.query_terms(self.text, X.stopword_set(self.stopwords, spark))

    def scored(self, s: Source, required: bool = True, rows: DataFrame | None = None) -> DataFrame:
        """The filtered rows, or ``rows``, with their score; with ``required`` only those that hold a word."""
        if self.scorer not in X.SCORERS:
            raise ValueError(f"unknown scorer {self.scorer!r}")
        spark = s.df.sparkSession
        df, terms, total, match = s.where(self.filter) if rows is None else rows, self.terms(spark), F.lit(0.0), F.lit(False)
        ctx = Context(s.schema, s.dtypes)
        if self.in_order and len(terms) > 1:
            match = F.lit(False)
        for name, weight in self.weights().items():
            words = [w for t in terms for w in X.tokenize(t)]
            stems = ctx.stems(name, words)
            tw = {st: float((self.text_weights or {}).get(w, 1.0)) for st, w in zip(stems, words)}
            col = f"_tokens_{name}"
            df = df.withColumn(col, ctx.tokens(name))
            if stems:
                # collection statistics are those of the whole table, not of the filtered rows
                stats = X.corpus_stats(s.df.select(ctx.tokens(name).alias("t")), "t", list(dict.fromkeys(stems)))
                total = total + F.lit(float(weight) * float(ctx.attr(name, "weight", 1.0))) * F.coalesce(X.score(col, stems, stats, self.scorer, tw), F.lit(0.0))
                hit = F.arrays_overlap(col, F.array(*[F.lit(x) for x in dict.fromkeys(stems)]))
                if self.in_order:
                    joined = F.concat(F.lit(" "), F.array_join(col, " "), F.lit(" "))
                    hit = joined.rlike(" " + "(?: .*)? ".join(stems) + " ")
                match = match | F.coalesce(hit, F.lit(False))
        drop = [f"_tokens_{n}" for n in self.weights()]
        df = df.withColumn(self.name, F.coalesce(total, F.lit(0.0)))
        if required and terms:
            df = df.where(F.coalesce(match, F.lit(False)))
        if self.scorer == "BM25STD.NORM":
            top = df.agg(F.max(self.name)).first()[0]
            df = df.withColumn(self.name, F.col(self.name) / F.lit(float(top)) if top else F.lit(0.0))
        return df.drop(*drop)

    def run(self, s: Source) -> DataFrame:
        df = self.scored(s).orderBy(F.col(self.name).desc(), s.key).limit(self.num_results)
        out = self._project(self._sort(df, s.key), s.key, [self.name] if self.return_score else [])
        return out if self.return_score or self.return_fields else out.drop(self.name)


def check_word_weights(weights: dict[str, float] | None) -> None:
    for k, v in (weights or {}).items():
        if not isinstance(k, str) or len(k.split()) != 1:
            raise ValueError(f"a weighted word is a single word: {k!r}")
        if isinstance(v, bool) or not isinstance(v, (int, float)) or v < 0:
            raise ValueError(f"the weight of {k!r} must not be negative")


@dataclass
class AggregateHybridQuery(TextQuery):
    """Nearest ``num_results`` rows, re-scored: ``(1 - alpha) * text_score + alpha * vector_similarity``."""

    vector: list[float] = field(default_factory=list)
    vector_field: str = ""
    alpha: float = 0.7

    def run(self, s: Source) -> DataFrame:
        if not self.text.strip() or not self.terms(s.df.sparkSession):
            raise ValueError("the text holds no word to search for")
        knn = VectorQuery(vector=self.vector, field_name=self.vector_field, num_results=self.num_results, filter=self.filter)
        nearest = knn.scored(s).orderBy("vector_distance", s.key).limit(self.num_results)
        df = replace(self, name="text_score").scored(s, required=False, rows=nearest)  # only these rows' texts are scored
        df = df.withColumn("vector_similarity", (2.0 - F.col("vector_distance")) / 2.0)
        df = df.withColumn("hybrid_score", (1.0 - self.alpha) * F.col("text_score") + self.alpha * F.col("vector_similarity"))
        return self._project(df.orderBy(F.col("hybrid_score").desc(), s.key), s.key, ["vector_distance", "vector_similarity", "text_score", "hybrid_score"])


@dataclass
class HybridQuery(TextQuery):
    """Two independently ranked legs, fused. ``RRF``: sum of ``1 / (constant + rank)`` within a window of each leg.
    ``LINEAR``: ``alpha * text + (1 - alpha) * vector similarity``. A leg that a row is missing from adds 0."""

    vector: list[float] = field(default_factory=list)
    vector_field: str = ""
    method: str = "KNN"
    range_radius: float | None = None
    combination: str = "RRF"
    rrf_window: int = 20
    rrf_constant: int = 60
    alpha: float = 0.3

    def run(self, s: Source) -> DataFrame:
        if self.combination not in ("RRF", "LINEAR") or self.method not in ("KNN", "RANGE"):
            raise ValueError("combination is RRF or LINEAR, method KNN or RANGE")
        if not self.terms(s.df.sparkSession):
            raise ValueError("the text holds no word to search for")
        window = max(self.rrf_window, self.num_results if self.combination == "LINEAR" else 0)
        text = replace(self, name="text_score").scored(s).select(s.key, "text_score")
        text = ranked(text.orderBy(F.col("text_score").desc(), s.key).limit(window), F.col("text_score").desc(), s.key, "text_rank")
        q = VectorQuery(vector=self.vector, field_name=self.vector_field, filter=self.filter)
        near = q.scored(s).select(s.key, "vector_distance")
        if self.method == "RANGE":
            near = near.where(F.col("vector_distance") <= F.lit(float(self.range_radius if self.range_radius is not None else 0.2)))
        near = near.orderBy("vector_distance", s.key).limit(window)
        near = ranked(near, F.col("vector_distance").asc(), s.key, "vector_rank").withColumn("vector_similarity", (2.0 - F.col("vector_distance")) / 2.0)
        both = text.join(near, s.key, "full_outer")  # at most two windows of rows
        if self.combination == "RRF":
            leg = lambda r: F.coalesce(1.0 / (F.lit(self.rrf_constant) + F.col(r)), F.lit(0.0))
            fused = leg("text_rank") + leg("vector_rank")
        else:
            fused = self.alpha * F.coalesce("text_score", F.lit(0.0)) + (1.0 - self.alpha) * F.coalesce("vector_similarity", F.lit(0.0))
        top = both.withColumn("hybrid_score", fused).orderBy(F.col("hybrid_score").desc(), s.key).limit(self.num_results)
        cols = ["text_score", "vector_distance", "vector_similarity", "hybrid_score"]
        out = s.df.join(F.broadcast(top.select(s.key, *cols)), s.key)  # num_results rows
        return self._project(out.orderBy(F.col("hybrid_score").desc(), s.key), s.key, cols)


def ranked(df: DataFrame, order: Column, key: str, name: str) -> DataFrame:
    """Ranks of a leg that has been cut to its window: the single partition of the sort holds a few rows."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(order, F.col(key))))


@dataclass
class VectorSpec:
    vector: list[float]
    field_name: str
    weight: float = 1.0
    max_distance: float = 2.0

    def __post_init__(self) -> None:
        if not 0.0 <= self.max_distance <= 2.0:
            raise ValueError("max_distance lies between 0 and 2")


@dataclass
class MultiVectorQuery(Query):
    """Rows within every ``max_distance``, by ``sum(weight * (2 - distance) / 2)``; weights may be negative."""

    vectors: list[VectorSpec] = field(default_factory=list)

    def run(self, s: Source) -> DataFrame:
        if not self.vectors:
            raise ValueError("at least one vector is needed")
        df, names, total = s.where(self.filter), [], F.lit(0.0)
        for i, v in enumerate(self.vectors):
            s.check_vector(v.field_name, v.vector)
            df = df.withColumn(f"distance_{i}", V.distance(s.metric(v.field_name), F.col(v.field_name), [float(x) for x in v.vector]))
            df = df.where(F.col(f"distance_{i}") <= F.lit(float(v.max_distance)))
            df = df.withColumn(f"score_{i}", (2.0 - F.col(f"distance_{i}")) / 2.0)
            total = total + F.lit(float(v.weight)) * F.col(f"score_{i}")
            names += [f"distance_{i}", f"score_{i}"]
        top = df.withColumn("combined_score", total).orderBy(F.col("combined_score").desc(), s.key).limit(self.num_results)
        return self._project(self._sort(top, s.key), s.key, [*names, "combined_score"])


def nearest_k(rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The ``k`` nearest rows of each ``query_id``, and what ties with the last of them."""
    rows = rows.sort_values(["query_id", "distance"], kind="stable", ignore_index=True)
    nth = rows.groupby("query_id", sort=False).cumcount()
    edge = rows["distance"].where(nth == k - 1).groupby(rows["query_id"], sort=False).transform("max")
    return rows[(nth < k) | (rows["distance"] <= edge + 1e-12)]


def batch_knn(corpus: DataFrame, key: str, vector: str, queries: DataFrame, query_id: str, query_vector: str, dims: int, k: int = 10, metric: str = "cosine", threshold: float | None = None) -> DataFrame:
    """``query_id, key, distance, rank``: the ``k`` nearest rows for each of a set of query vectors, exact.

    The queries go to every task in rounds of ``BATCH_QUERIES``; each Arrow batch of the corpus is multiplied
    with them at once and each task leaves at most ``k`` rows for each query (and what ties with the last), so what is shuffled is
    ``tasks x queries x k`` small rows and never a pair of all. Rows and queries without a usable vector
    are left out; equal distances are ordered by key.
    """
    kind, qkind = corpus.schema[key].dataType, queries.schema[query_id].dataType
    out_type = T.StructType([T.StructField("query_id", qkind), T.StructField("key", kind), T.StructField("distance", T.DoubleType())])
    rows = queries.select(query_id, query_vector).where(F.col(query_vector).isNotNull() & (F.size(query_vector) == dims)).collect()
    parts = []
    for at in range(0, max(1, len(rows)), BATCH_QUERIES):
        ids = [r[0] for r in rows[at : at + BATCH_QUERIES]]
        q = np.array([r[1] for r in rows[at : at + BATCH_QUERIES]], "float64").reshape(-1, dims)
        norm = np.sqrt((q * q).sum(axis=1))
        good = np.isfinite(norm) & ((norm > 0) | (metric != "cosine"))
        ids, q, norm = [i for i, g in zip(ids, good) if g], q[good], norm[good]
        shared = corpus.sparkSession.sparkContext.broadcast((ids, q, norm))

        def run(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            # one list of the k best for each query and task
            best: pd.DataFrame | None = None
            for found in some(batches, shared):
                best = found if best is None else pd.concat([best, found], ignore_index=True)
                if len(best) > KEPT_ROWS + 2 * k * len(shared.value[0]):
                    best = nearest_k(best, k)
            if best is not None:
                yield nearest_k(best, k)

        def some(batches: Iterator[pd.DataFrame], shared) -> Iterator[pd.DataFrame]:
            ids, q, norm = shared.value
            for batch in batches:
                x = np.array(batch["vec"].tolist(), "float64").reshape(-1, dims)
                own = np.sqrt((x * x).sum(axis=1))
                fine = np.isfinite(own) & ((own > 0) | (metric != "cosine"))
                x, own, keys = x[fine], own[fine], batch["key"].to_numpy()[fine]
                if not len(x) or not len(q):
                    continue
                for at in range(0, len(q), TILE_QUERIES):
                    part = slice(at, at + TILE_QUERIES)
                    dots = q[part] @ x.T
                    if metric == "cosine":
                        d = 1.0 - dots / (norm[part, None] * own[None, :])
                    elif metric == "ip":
                        d = 1.0 - dots
                    else:
                        d = np.sqrt(np.maximum(norm[part, None] ** 2 + own[None, :] ** 2 - 2 * dots, 0))
                    m = min(k, len(x))
                    # all that tie with the k-th are kept, so that the key decides among them at the end
                    edge = np.partition(d, m - 1, axis=1)[:, m - 1 : m] + 1e-12
                    i, j = np.nonzero(d <= (edge if threshold is None else np.minimum(edge, threshold)))
                    if len(i):
                        yield pd.DataFrame({"query_id": [ids[at + c] for c in i], "key": keys[j], "distance": d[i, j]})

        rows_in = corpus.select(F.col(key).alias("key"), F.col(vector).alias("vec")).where(F.col("vec").isNotNull() & (F.size("vec") == dims) & ~F.exists("vec", lambda v: v.isNull()))
        parts.append(rows_in.mapInPandas(run, out_type))
    near = parts[0]
    for p in parts[1:]:
        near = near.unionByName(p)
    w = Window.partitionBy("query_id").orderBy(F.round("distance", 12), "key")  # equal but for rounding is equal
    return near.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
