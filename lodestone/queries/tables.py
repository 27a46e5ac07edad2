"""Index schemas of the dataset tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators.search import Source
from lodestone.schema import IndexSchema
from lodestone.sources.tables import table

FIELDS = {
    "orders": ("o_orderkey", [("o_orderstatus", "tag", {}), ("o_totalprice", "numeric", {}), ("o_orderdate", "numeric", {}), ("o_orderpriority", "tag", {}), ("o_custkey", "numeric", {})]),
    "customer": ("c_custkey", [("c_name", "text", {"no_stem": True}), ("c_nationkey", "numeric", {}), ("c_acctbal", "numeric", {}), ("c_mktsegment", "tag", {})]),
    "part": ("p_partkey", [("p_name", "text", {"no_stem": True}), ("p_brand", "tag", {}), ("p_type", "tag", {}), ("p_size", "numeric", {}), ("p_retailprice", "numeric", {})]),
    "lineitem": ("l_orderkey", [(c, "numeric", {}) for c in ("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate")] + [("l_returnflag", "tag", {}), ("l_linestatus", "tag", {})]),
    "events": ("event_id", [("ts", "numeric", {}), ("user_id", "numeric", {}), ("event_type", "tag", {}), ("value", "numeric", {})]),
    "embeddings": ("vec_id", [("embedding", "vector", {"dims": 64}), ("label", "numeric", {})]),
    "users": ("user", [("age", "numeric", {}), ("job", "tag", {}), ("description", "text", {"no_stem": True}), ("last_updated", "numeric", {}), ("credit_score", "tag", {}), ("location", "geo", {}), ("user_embedding", "vector", {"dims": 3})]),
    "documents": ("doc_id", [("text", "text", {"no_stem": True}), ("lang", "tag", {}), ("source", "tag", {}), ("n_chars", "numeric", {}), ("kind", "tag", {})]),
    "llm_cache": ("entry_id", [("prompt", "text", {"no_stem": True}), ("response", "text", {}), ("inserted_at", "numeric", {}), ("updated_at", "numeric", {}), ("prompt_vector", "vector", {"dims": 64})]),
    "supplier": ("s_suppkey", [("s_name", "text", {"no_stem": True}), ("s_nationkey", "numeric", {}), ("s_acctbal", "numeric", {})]),
}


def schema(name: str, metric: str = "cosine", stopwords: list[str] | None = None) -> IndexSchema:
    fields = [{"name": n, "type": t, "attrs": {**a, **({"distance_metric": metric} if t == "vector" else {})}} for n, t, a in FIELDS[name][1]]
    return IndexSchema.from_dict({"index": {"name": name, "prefix": name, "stopwords": stopwords}, "fields": fields})


def source(spark: SparkSession, d: str, name: str, metric: str = "cosine", df: DataFrame | None = None) -> Source:
    return Source(table(spark, d, name) if df is None else df, schema(name, metric), FIELDS[name][0])


def query_vector(spark: SparkSession, d: str, vec_id: int = 0) -> list[float]:
    """The vector of one row, as the query of a search."""
    return list(table(spark, d, "embeddings").where(F.col("vec_id") == vec_id).select("embedding").first()[0])


#: The same vector in SQL.
Q0 = "(SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)"
