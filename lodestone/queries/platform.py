"""Scans, writes and maintenance S1-S17, extensions E1-E17, plug-ins U1-U8, migration M1-M11, compression, tools, streaming."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import udf as U
from lodestone.functions import vectors as V
from lodestone.operators import caching as C
from lodestone.operators import history as H
from lodestone.operators import migration as M
from lodestone.operators import routing as R
from lodestone.operators.filters import Num, Tag
from lodestone.operators.index import SearchIndex
from lodestone.plans.physical import checkpoint_dir
from lodestone.queries.filtering import TOKENS
from lodestone.queries.tables import FIELDS, Q0, query_vector, schema
from lodestone.schema import IndexSchema
from lodestone.sources.tables import table


def index(spark, d, name, df=None) -> SearchIndex:
    return SearchIndex(schema(name), table(spark, d, name) if df is None else df, FIELDS[name][0])


def upsert(spark, d):
    """Raised balances of some customers, and new customers, loaded over the old table."""
    c = table(spark, d, "customer")
    i = index(spark, d, "customer")
    i.load(c.where("c_acctbal < 0").withColumn("c_acctbal", F.col("c_acctbal") + 1000))
    i.load(c.where("c_nationkey = 7").withColumn("c_custkey", F.col("c_custkey") + 10_000_000))
    return i.df.select("c_custkey", "c_nationkey", F.round("c_acctbal", 4).alias("c_acctbal"))


def dropped(spark, d):
    i = index(spark, d, "events")
    i.drop_by_filter(Tag("event_type") == ["error", "signup"])
    return i.df.select("event_id", "event_type")


def updated(spark, d):
    i = index(spark, d, "part")
    i.update_by_filter((Num("p_size") > 40) & (Tag("p_brand") == "brand#3"), {"p_type": "PROMO", "p_retailprice": 1.5})
    return i.df.select("p_partkey", "p_type", "p_retailprice")


def expired(spark, d):
    """Events given a time to live that ends with their own day are not seen any more; a refreshed one is."""
    e = table(spark, d, "events")
    i = SearchIndex(schema("events"), e.withColumn("_expires_at", F.when(F.col("event_type") != "view", F.col("ts").cast("timestamp") + F.expr("INTERVAL 1 DAY"))), "event_id")
    return i.df.select("event_id")


def fetched(spark, d):
    i = index(spark, d, "orders")
    row = i.fetch("100")
    return spark.createDataFrame([(row["o_orderkey"], row["o_totalprice"])], "o_orderkey long, o_totalprice double")


def stats(spark, d):
    s = index(spark, d, "part").stats()
    return spark.createDataFrame([(s["num_docs"], s["num_terms"])], "num_docs long, num_terms long")


def inferred(spark, d):
    base = IndexSchema.from_dict({"index": {"name": "x"}, "fields": []})
    got = base.generate_fields(table(spark, d, "users"))
    return spark.createDataFrame([(f["name"], f["type"]) for f in got], "name string, type string")


def validated(spark, d):
    s = IndexSchema.from_dict({"index": {"name": "x"}, "fields": [{"name": "vector_field", "type": "vector", "attrs": {"dims": 64}}, {"name": "content", "type": "text"}]})
    e = s.errors(table(spark, d, "chat_messages"))
    return e.where(F.size("_errors") > 0).groupBy(F.col("_errors")[0].alias("error")).agg(F.count("*").alias("n"))


def cache_check(spark, d):
    """Each cached prompt, and three vectors from elsewhere, against the whole cache: the nearest entries within the threshold, its own first."""
    c = table(spark, d, "llm_cache").groupBy("entry_id").agg(F.min("prompt").alias("prompt"), F.min("response").alias("response"), F.min("prompt_vector").alias("prompt_vector"), F.min("inserted_at").alias("inserted_at"), F.min("updated_at").alias("updated_at"))
    c = c.where((F.size("prompt_vector") == 64))
    cache = C.SemanticCache(SearchIndex(C.cache_schema("cache", 64), c, "entry_id"), 0.3)
    asked = spark.createDataFrame([(f"vec {k}", query_vector(spark, d, k)) for k in range(3)], "q string, v array<float>").unionByName(c.select(F.col("entry_id").alias("q"), F.col("prompt_vector").alias("v")))
    out = cache.check_batch(asked, "q", "v", 5)
    return out.select("query_id", "key", "rank", F.round("distance", 6).alias("distance"))


def cache_ids(spark, d):
    return table(spark, d, "llm_cache").select("entry_id", C.entry_id_column(F.col("prompt"), [("lang", F.lit("en"))]).alias("id"))


def embeddings_cache(spark, d):
    """Texts looked up by hash of content and model; those that are missing show null."""
    s = table(spark, d, "sentence_vectors").where("sentence IS NOT NULL").groupBy("sentence").agg(F.min("embedding").alias("embedding"))
    stored = s.where(F.length("sentence") < 80).select(F.col("sentence").alias("content"), F.lit("m1").alias("model_name"), "embedding", F.lit("").alias("metadata"))
    cache = C.EmbeddingsCache(stored.limit(0).withColumn("entry_id", F.lit("")))
    cache.mset(stored)
    got = cache.mget(s.select(F.col("sentence").alias("content"), F.lit("m1").alias("model_name")))
    return got.select("entry_id", F.col("cached_metadata").isNotNull().alias("hit"))


def recent(spark, d):
    chat = table(spark, d, "chat_messages").where("timestamp IS NOT NULL AND NOT isnan(timestamp)").dropDuplicates(["entry_id"])
    return H.recent_of_all(chat, 3).select("session_tag", "entry_id", "recency")


def relevant(spark, d):
    chat = table(spark, d, "chat_messages").where(F.size("vector_field") == 64).dropDuplicates(["entry_id"])
    h = H.MessageHistory(chat, "ops-watch")
    return h.get_relevant(query_vector(spark, d), top_k=15, distance_threshold=0.95).select("entry_id", F.round("vector_distance", 6).alias("vector_distance"))


def routed(spark, d):
    refs = table(spark, d, "router_references").withColumn("route_name", F.lower("route_name"))
    got = R.route_table(table(spark, d, "sentence_vectors").dropDuplicates(["record_key"]), "record_key", "embedding", refs, 64, R.RoutingConfig(2, "avg"))
    return got.select("query_id", "route_name", F.round("distance", 5).alias("distance"))


def quantised(to):
    return lambda spark, d: table(spark, d, "embeddings").select("vec_id", V.quantise(F.col("embedding"), to).alias("q"))


def quant_sql(low: int, mid: int) -> str:
    x = f"(CASE WHEN hi > lo THEN round_even((x::DOUBLE - lo) / (hi - lo) * 255, 0) + {low} ELSE {mid} END)::INTEGER"
    return f"SELECT vec_id, list_transform(embedding, lambda x: {x}) AS q FROM (SELECT vec_id, embedding, list_min(embedding)::DOUBLE AS lo, list_max(embedding)::DOUBLE AS hi FROM embeddings)"


@F.pandas_udf(T.BinaryType())
def _pack(s: pd.Series) -> pd.Series:
    return s.map(lambda v: V.to_bytes(v, "float32"))


def converted(spark, d):
    """float32 bytes to float16 bytes; their length tells the type again."""
    e = table(spark, d, "embeddings").select("vec_id", _pack("embedding").alias("b"))
    return V.convert(e, "b", "float32", "float16").select("vec_id", F.octet_length("b").alias("n_bytes"))


def migrated(spark, d):
    """Rename a field, move the keys to another prefix; written beside the old version, validated, switched."""
    path = f"{checkpoint_dir(spark)}/migration-{uuid.uuid4().hex}"
    a = IndexSchema.from_dict({"index": {"name": "e", "prefix": "old"}, "fields": [{"name": "label", "type": "numeric"}, {"name": "embedding", "type": "vector", "attrs": {"dims": 64}}]})
    b, renames = M.merge(a, {"index": {"prefix": "new"}, "rename_fields": [{"old_name": "label", "new_name": "topic"}]})
    i = SearchIndex(a, None, "key", path)
    rows = table(spark, d, "embeddings").withColumn("key", F.concat(F.lit("old:"), F.col("vec_id").cast("string"))).drop("vec_id")
    i.load(rows)
    m = M.Migrator(spark, path)
    result = m.apply(M.plan(a, b, renames))
    if not result.passed:
        raise ValueError(f"the migration failed: {result}")
    return SearchIndex(b, None, "key", path).df.select("key", "topic")


def compression(spark, d):
    rows = [(dims, p, c["compression"], M.memory_savings(c["compression"], dims, c["reduce"])) for dims in (384, 768, 1024, 1536) for p in ("speed", "memory", "balanced") for c in [M.recommend(dims, p)]]
    return spark.createDataFrame(rows, "dims int, priority string, compression string, saved double")


def embedded(spark, d):
    v = U.CustomVectorizer(lambda t: [float(len(t)), float(t.count(" ")), 1.0])
    return U.embed_column(table(spark, d, "part"), "p_name", "v", v).select("p_partkey", F.transform("v", lambda x: x.cast("int")).alias("v"))


def reranked(spark, d):
    out = U.rerank(table(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("content")), "small ring 7", "content", U.overlap_scorer, 5)
    return out.select("p_partkey", F.round("score", 6).alias("score"))


def streamed(spark, d):
    """Tumbling windows over the event stream, with late rows counted within the watermark."""
    from lodestone.streaming.ingest import windowed_counts

    schema_ = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema_).option("pathGlobFilter", "*.parquet").parquet(_stream_dir(spark, d)).withColumn("t", F.col("ts").cast("timestamp"))
    counted = windowed_counts(stream, "t", "1 day", "40 days", ["event_type"])
    name, at = f"w_{uuid.uuid4().hex}", f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    q = counted.writeStream.format("memory").queryName(name).outputMode("complete").option("checkpointLocation", at).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def _stream_dir(spark, d) -> str:
    """The events as a folder that a stream can watch, in the shared folder."""
    path = f"{checkpoint_dir(spark)}/events-{uuid.uuid4().hex}"
    table(spark, d, "events").write.parquet(path)
    return path


CACHE = "(SELECT entry_id, min(prompt) AS prompt FROM llm_cache GROUP BY entry_id)"
SENT = "(SELECT sentence FROM sentence_vectors WHERE sentence IS NOT NULL GROUP BY sentence)"

USABLE = "len({0}) = 64 AND NOT list_bool_or(list_transform({0}, lambda x: isnan(x))) AND list_bool_or(list_transform({0}, lambda x: x <> 0))"
CHECK_SQL = f"""
WITH c AS (SELECT entry_id, min(prompt_vector)::DOUBLE[] AS v FROM llm_cache GROUP BY entry_id HAVING {USABLE.format("min(prompt_vector)")}),
 asked AS (SELECT entry_id AS q, v FROM c UNION ALL SELECT 'vec ' || vec_id, embedding::DOUBLE[] FROM embeddings WHERE vec_id < 3),
 near AS (SELECT q, entry_id, list_cosine_distance(asked.v, c.v) AS d FROM asked, c)
SELECT q AS query_id, entry_id AS key, round(d, 6) + 0.0 AS distance, row_number() OVER (PARTITION BY q ORDER BY round(d, 12), entry_id)::INTEGER AS rank FROM near WHERE d <= 0.3 QUALIFY rank <= 5
"""
COMPRESSION_SQL = """
SELECT dims, priority, CASE WHEN dims >= 1024 THEN 'LeanVec4x8' WHEN priority = 'memory' THEN 'LVQ4' WHEN priority = 'speed' THEN 'LVQ4x8' ELSE 'LVQ4x4' END AS compression,
 CASE WHEN dims >= 1024 AND priority = 'speed' THEN 90.6 WHEN dims >= 1024 THEN 81.2 WHEN priority = 'memory' THEN 87.5 WHEN priority = 'speed' THEN 62.5 ELSE 75.0 END::DOUBLE AS saved
FROM (VALUES (384), (768), (1024), (1536)) a(dims), (VALUES ('speed'), ('memory'), ('balanced')) b(priority)
"""

ROUTE_SQL = """
WITH refs AS (SELECT reference_id, min(lower(route_name)) AS route, arg_min(vector::DOUBLE[], lower(route_name)) AS v FROM router_references GROUP BY 1),
 lim AS (SELECT lower(route_name) AS route, coalesce(max(distance_threshold), 0.5) AS t FROM router_references GROUP BY 1),
 s AS (SELECT record_key, any_value(embedding::DOUBLE[]) AS e FROM sentence_vectors WHERE len(embedding) = 64 AND NOT list_bool_or(list_transform(embedding, lambda x: isnan(x))) AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) GROUP BY 1),
 near AS (SELECT record_key, route, list_cosine_distance(e, v) AS d FROM s, refs WHERE list_cosine_distance(e, v) <= (SELECT max(t) FROM lim)),
 agg AS (SELECT record_key, route, avg(d) AS d FROM near GROUP BY 1, 2),
 best AS (SELECT *, row_number() OVER (PARTITION BY record_key ORDER BY d, route) AS r FROM agg)
SELECT record_key AS query_id, best.route AS route_name, round(d, 5) AS distance FROM best JOIN lim ON lim.route = best.route WHERE r <= 2 AND d < t
"""

QUERIES = {
    "s1_scan": (lambda spark, d: index(spark, d, "supplier").df, "SELECT * FROM supplier"),
    "s2_upsert": (upsert, "SELECT c_custkey, c_nationkey, round(CASE WHEN c_acctbal < 0 THEN c_acctbal + 1000 ELSE c_acctbal END, 4) AS c_acctbal FROM customer UNION ALL SELECT c_custkey + 10000000, c_nationkey, round(c_acctbal, 4) FROM customer WHERE c_nationkey = 7"),
    "s4_fetch": (fetched, "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey = 100"),
    "s9_expired": (expired, "SELECT event_id FROM events WHERE event_type = 'view'"),
    "s10_drop_by_filter": (dropped, "SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')"),
    "s11_update_by_filter": (updated, "SELECT p_partkey, CASE WHEN p_size > 40 AND p_brand = 'Brand#3' THEN 'PROMO' ELSE p_type END AS p_type, CASE WHEN p_size > 40 AND p_brand = 'Brand#3' THEN 1.5 ELSE p_retailprice END AS p_retailprice FROM part"),
    "s14_inferred_schema": (inferred, "SELECT * FROM (VALUES ('user', 'text'), ('age', 'numeric'), ('job', 'text'), ('description', 'text'), ('last_updated', 'numeric'), ('credit_score', 'text'), ('location', 'geo'), ('user_embedding', 'vector')) t(name, type)"),
    "s15_stats": (stats, f"SELECT count(*) AS num_docs, (SELECT count(DISTINCT t) FROM (SELECT unnest({TOKENS.format('p_name')}) AS t FROM part)) AS num_terms FROM part"),
    "v1_validation": (validated, "SELECT 'vector_field: expected 64 dimensions' AS error, count(*) AS n FROM chat_messages WHERE len(vector_field) <> 64"),
    "e1_cache_check": (cache_check, CHECK_SQL),
    "e2_cache_ids": (cache_ids, "SELECT entry_id, sha256(prompt || 'lang' || 'en') AS id FROM llm_cache"),
    "e5_embeddings_cache": (embeddings_cache, f"SELECT sha256(sentence || ':m1') AS entry_id, length(sentence) < 80 AS hit FROM {SENT}"),
    "e8_recent_messages": (recent, "SELECT session_tag, entry_id, recency FROM (SELECT session_tag, entry_id, row_number() OVER (PARTITION BY session_tag ORDER BY timestamp DESC, entry_id DESC)::INTEGER AS recency FROM (SELECT entry_id, any_value(session_tag) AS session_tag, any_value(timestamp) AS timestamp FROM chat_messages WHERE timestamp IS NOT NULL AND NOT isnan(timestamp) AND session_tag IS NOT NULL GROUP BY entry_id, session_tag)) WHERE recency <= 3"),
    "e12_relevant_messages": (relevant, f"SELECT entry_id, round(d, 6) AS vector_distance FROM (SELECT entry_id, list_cosine_distance(v, {Q0}) AS d FROM (SELECT entry_id, any_value(vector_field::DOUBLE[]) AS v FROM chat_messages WHERE session_tag = 'ops-watch' AND {USABLE.format('vector_field')} GROUP BY entry_id)) WHERE d <= 0.95 ORDER BY d, entry_id LIMIT 15"),
    "e13_router": (routed, ROUTE_SQL),
    "u1_embed": (embedded, "SELECT p_partkey, [length(p_name), length(p_name) - length(replace(p_name, ' ', '')), 1] AS v FROM part"),
    "u6_rerank": (reranked, "SELECT p_partkey, round(n / 3.0, 6) AS score FROM (SELECT p_partkey, p_name || ' ' || p_partkey AS c, list_contains(w, 'small')::INT + list_contains(w, 'ring')::INT + list_contains(w, '7')::INT AS n FROM (SELECT *, string_split(lower(p_name || ' ' || p_partkey), ' ') AS w FROM part)) ORDER BY n DESC, c LIMIT 5"),
    "m1_quantise_int8": (quantised("int8"), quant_sql(-128, 0)),
    "m1_quantise_uint8": (quantised("uint8"), quant_sql(0, 128)),
    "m2_convert_bytes": (converted, "SELECT vec_id, 128 AS n_bytes FROM embeddings"),
    "m7_migration": (migrated, "SELECT 'new:' || vec_id AS key, label AS topic FROM embeddings"),
    "c1_compression": (compression, COMPRESSION_SQL),
    "st_windowed_counts": (streamed, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
}
