"""Semantic routing: which route a vector belongs to, by the distances of the routes' reference vectors."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pandas as pd
import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.sources import store

#: Reductions over the references of a route (fixed values).
AGGREGATES = ("avg", "min", "sum")


@dataclass
class Route:
    name: str
    references: list[str]
    metadata: dict[str, Any] = field(default_factory=dict)
    distance_threshold: float = 0.5

    def __post_init__(self) -> None:
        if not self.name.strip():
            raise ValueError("a route needs a name")
        if not self.references or not all(r.strip() for r in self.references):
            raise ValueError("a route needs references that are not empty")
        if not 0 < self.distance_threshold <= 2:
            raise ValueError("the threshold lies above 0 and at most at 2")


@dataclass
class RoutingConfig:
    max_k: int = 1
    aggregation: str = "avg"

    def __post_init__(self) -> None:
        if self.max_k < 1 or self.aggregation not in AGGREGATES:
            raise ValueError("max_k is positive, aggregation avg, min or sum")


@dataclass
class RouteMatch:
    name: str | None = None
    distance: float | None = None


def route_table(queries: DataFrame, query_id: str, vector: str, references: DataFrame, dims: int, config: RoutingConfig, max_references: int = 100_000) -> DataFrame:
    """``query_id, route_name, distance`` of the routes that each query matches.

    References within the largest threshold of all routes are aggregated for each route; the routes are
    sorted and cut to ``max_k``; only then the strict threshold of each route decides. The references are a
    parameter table: their number is checked, and each batch of queries is multiplied with all of them, so
    nothing is shuffled. A route without threshold has 0.5.
    """
    if references.limit(max_references + 1).count() > max_references:
        raise ValueError(f"more than {max_references} reference vectors")
    refs = references.groupBy("reference_id").agg(F.min("route_name").alias("route"), F.min_by("vector", "route_name").alias("vector"))
    limits = {r[0]: r[1] for r in references.groupBy("route_name").agg(F.max("distance_threshold")).collect()}
    rows = [r for r in refs.orderBy("reference_id").collect() if r["vector"] is not None and len(r["vector"]) == dims]
    names = sorted({r["route"] for r in rows})
    limit = np.array([0.5 if limits.get(n) is None else limits[n] for n in names])
    m = np.array([r["vector"] for r in rows], "float64").reshape(-1, dims)
    norm = np.sqrt((m * m).sum(axis=1))
    good = np.isfinite(norm) & (norm > 0)
    m, of = m[good] / norm[good, None], np.array([names.index(r["route"]) for r in rows], int)[good]
    top, how, keep = float(limit.max()) if len(limit) else 0.0, config.aggregation, config.max_k
    member = np.eye(len(names))[of] if len(names) else np.zeros((0, 0))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = np.array(batch["vec"].tolist(), "float64").reshape(-1, dims)
            own = np.sqrt((x * x).sum(axis=1))
            fine = np.isfinite(own) & (own > 0)
            x, ids = x[fine] / own[fine, None], batch["query_id"].to_numpy()[fine]
            if not len(x) or not len(m):
                continue
            d = 1.0 - x @ m.T
            inside = d <= top
            n = inside @ member
            if how == "min":
                total = np.stack([np.where(inside[:, of == r], d[:, of == r], np.inf).min(axis=1) for r in range(len(names))], axis=1)
            else:
                total = np.where(inside, d, 0.0) @ member
                total = np.where(n > 0, total / np.maximum(n, 1) if how == "avg" else total, np.inf)
            order = np.argsort(total, axis=1, kind="stable")[:, :keep]
            value = np.take_along_axis(total, order, axis=1)
            i, j = np.nonzero(value < limit[order])
            if len(i):
                yield pd.DataFrame({"query_id": ids[i], "route_name": [names[r] for r in order[i, j]], "distance": value[i, j]})

    schema = T.StructType([T.StructField("query_id", queries.schema[query_id].dataType), T.StructField("route_name", T.StringType()), T.StructField("distance", T.DoubleType())])
    rows_in = queries.select(F.col(query_id).alias("query_id"), F.col(vector).alias("vec")).where((F.size("vec") == dims) & ~F.exists("vec", lambda v: v.isNull()))
    return rows_in.mapInPandas(run, schema)


class SemanticRouter:
    def __init__(self, name: str, routes: list[Route], embed, config: RoutingConfig | None = None, spark: SparkSession | None = None) -> None:
        self.name, self.embed, self.config = name, embed, config or RoutingConfig()
        self.routes = {r.name: r for r in routes}
        self.spark = spark or SparkSession.active()
        #: Vectors of references that have been embedded once.
        self.vectors: dict[str, list[float]] = {}

    @staticmethod
    def reference_id(route: str, reference: str) -> str:
        return f"{route}:{hashlib.sha256(reference.encode()).hexdigest()}"

    def references(self) -> DataFrame:
        for r in self.routes.values():
            for t in r.references:
                if t not in self.vectors:
                    self.vectors[t] = [float(x) for x in self.embed(t)]
        rows = [(self.reference_id(r.name, t), r.name, t, self.vectors[t], float(r.distance_threshold)) for r in self.routes.values() for t in r.references]
        return self.spark.createDataFrame(rows, "reference_id string, route_name string, reference string, vector array<float>, distance_threshold double")

    def route_many(self, statement: str | None = None, vector: list[float] | None = None, max_k: int | None = None, aggregation: str | None = None) -> list[RouteMatch]:
        if (statement is None) == (vector is None):
            raise ValueError("a statement or a vector is needed")
        v = [float(x) for x in (vector if vector is not None else self.embed(statement))]
        config = RoutingConfig(max_k or self.config.max_k, aggregation or self.config.aggregation)
        q = self.spark.createDataFrame([(0, v)], "id int, v array<float>")
        rows = route_table(q, "id", "v", self.references(), len(v), config).orderBy("distance", "route_name").collect()
        return [RouteMatch(r["route_name"], r["distance"]) for r in rows]

    def __call__(self, statement: str | None = None, vector: list[float] | None = None) -> RouteMatch:
        got = self.route_many(statement, vector, max_k=1)
        return got[0] if got else RouteMatch()

    def get(self, name: str) -> Route | None:
        return self.routes.get(name)

    def add_routes(self, routes: list[Route]) -> None:
        self.routes.update({r.name: r for r in routes})

    def remove_route(self, name: str) -> None:
        self.routes.pop(name, None)

    def update_route(self, route: Route) -> None:
        if route.name not in self.routes:
            raise KeyError(route.name)
        self.routes[route.name] = route

    def update_routing_config(self, config: RoutingConfig) -> None:
        self.config = config

    def update_route_thresholds(self, thresholds: dict[str, float]) -> None:
        for n, t in thresholds.items():
            old = self.routes[n]
            self.routes[n] = Route(n, old.references, old.metadata, t)

    def add_route_references(self, name: str, references: str | list[str]) -> list[str]:
        new = [references] if isinstance(references, str) else references
        self.routes[name].references = list(dict.fromkeys([*self.routes[name].references, *new]))
        return [self.reference_id(name, r) for r in new]

    def get_route_references(self, name: str | None = None, reference_ids: list[str] | None = None) -> DataFrame:
        refs = self.references()
        return refs.where(F.col("reference_id").isin(reference_ids)) if reference_ids else refs.where(F.col("route_name") == name)

    def delete_route_references(self, name: str, references: list[str] | None = None, reference_ids: list[str] | None = None) -> int:
        r = self.routes[name]
        gone = set(references or []) | {t for t in r.references if self.reference_id(name, t) in set(reference_ids or [])}
        kept = [t for t in r.references if t not in gone]
        n = len(r.references) - len(kept)
        r.references = kept
        return n

    def to_dict(self) -> dict[str, Any]:
        return {
            "name": self.name,
            "routes": [{"name": r.name, "references": r.references, "metadata": r.metadata, "distance_threshold": r.distance_threshold} for r in self.routes.values()],
            "routing_config": {"max_k": self.config.max_k, "aggregation_method": self.config.aggregation},
        }

    @classmethod
    def from_dict(cls, d: dict[str, Any], embed, spark: SparkSession | None = None) -> SemanticRouter:
        c = d.get("routing_config") or {}
        return cls(d["name"], [Route(**r) for r in d["routes"]], embed, RoutingConfig(c.get("max_k", 1), c.get("aggregation_method", "avg")), spark)

    def save(self, path: str) -> None:
        """The configuration and the references with their vectors, in a folder of any storage."""
        self.references().write.mode("overwrite").parquet(f"{path}/references")
        store.write_json(self.spark, f"{path}/ROUTER", self.to_dict())

    @classmethod
    def from_existing(cls, path: str, embed, spark: SparkSession | None = None) -> SemanticRouter:
        """The router that was saved to ``path``; its references are not embedded again."""
        spark = spark or SparkSession.active()
        out = cls.from_dict(store.read_json(spark, f"{path}/ROUTER"), embed, spark)
        out.vectors = {r["reference"]: list(r["vector"]) for r in spark.read.parquet(f"{path}/references").select("reference", "vector").collect()}
        return out

    def to_yaml(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            yaml.safe_dump(self.to_dict(), f, sort_keys=False)

    @classmethod
    def from_yaml(cls, path: str, embed, spark: SparkSession | None = None) -> SemanticRouter:
        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f), embed, spark)
