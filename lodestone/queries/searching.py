"""Queries Q1-Q13, distances D1-D8 and full-text T1-T8."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestone.functions import text as X
from lodestone.functions import vectors as V
from lodestone.operators import search as S
from lodestone.operators.ann import CellIndex
from lodestone.operators.filters import Num, Tag
from lodestone.operators.index import SearchIndex
from lodestone.queries.filtering import TOKENS, metres
from lodestone.queries.tables import Q0, query_vector, source
from lodestone.sources.tables import table

COS = f"list_cosine_distance(embedding::DOUBLE[], {Q0})"
K1, B = X.K1, X.B


def knn(spark, d, **kw):
    metric = kw.pop("metric", "cosine")
    s = source(spark, d, "embeddings", metric)
    q = S.VectorQuery(vector=query_vector(spark, d), field_name="embedding", **kw)
    return q.run(s).select("vec_id", "label", F.round("vector_distance", 6).alias("vector_distance"))


def vrange(spark, d, **kw):
    s = source(spark, d, "embeddings")
    q = S.VectorRangeQuery(vector=query_vector(spark, d), field_name="embedding", **kw)
    return q.run(s).select("vec_id", F.round("vector_distance", 6).alias("vector_distance"))


def distances(spark, d):
    v, e = query_vector(spark, d), F.col("embedding")
    cos, l2 = V.cosine_distance(e, v), V.l2_distance(e, v)
    six = lambda c, n: F.round(c, 6).alias(n)
    return table(spark, d, "embeddings").select("vec_id", six(cos, "cosine"), six(l2, "l2"), six(V.ip_distance(e, v), "ip"), six(V.norm_cosine(cos), "cosine_similarity"), six(V.norm_l2(l2), "l2_similarity"))


def batch(spark, d):
    e = table(spark, d, "embeddings")
    out = S.batch_knn(e, "vec_id", "embedding", e.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding", 64, 10)
    return out.select(F.col("query_id"), F.col("key").alias("vec_id"), "rank", F.round("distance", 6).alias("distance"))


def cells(spark, d):
    """Approximate neighbours of the same queries; these vectors hardly cluster, so 0.9 of the true ones takes most of the cells."""
    e = table(spark, d, "embeddings")
    index = CellIndex.build(e, "vec_id", "embedding", 64)
    out = index.search(e.where(F.col("vec_id") % 50 == 0), "vec_id", "embedding", 10, probes=max(1, round(0.65 * len(index.centres))))
    return out.select("query_id", F.col("key").alias("vec_id"), "rank", F.round("distance", 6).alias("distance"))


def text(spark, d, scorer="BM25STD", n=10, required=True, words="page cursor during the nightly run", **kw):
    q = S.TextQuery(text=words, fields="text", scorer=scorer, num_results=n, **kw)
    s = source(spark, d, "documents")
    if not required:
        return q.scored(s, required=False).select("doc_id", F.round("score", 6).alias("score"))
    return q.run(s).select("doc_id", F.round("score", 6).alias("score"))


#: Query words that are no stop words, for the SQL below.
TERMS = ["page", "cursor", "nightly", "run"]


def bm25(table: str, key: str, column: str, terms: list[str], weights: dict[str, float] | None = None, where: str = "TRUE") -> str:
    """CTEs ``scored(key, score, hit)`` of every row of a table."""
    w = weights or {}
    values = ", ".join(f"('{t}', {float(w.get(t, 1.0)) * terms.count(t)})" for t in dict.fromkeys(terms))
    return f"""
 q(term, w) AS (VALUES {values}),
 doc AS (SELECT {key} AS k, {TOKENS.format(column)} AS toks FROM {table}),
 stat AS (SELECT count(*) AS n, avg(coalesce(len(toks), 0)) AS avgl FROM doc),
 dfs AS (SELECT term, w, (SELECT count(*) FROM doc WHERE list_contains(toks, term)) AS df FROM q),
 part AS (SELECT k, len(toks) AS len, len(list_filter(toks, lambda x: x = term))::DOUBLE AS tf, w, ln(1 + (n - df + 0.5) / (df + 0.5)) AS idf, log2(1 + n / greatest(1, df)) AS tidf, avgl FROM doc, dfs, stat WHERE toks IS NOT NULL),
 scored AS (SELECT k, sum(w * idf * tf * ({K1} + 1) / (tf + {K1} * (1 - {B} + {B} * len / avgl))) AS score, sum(w * tf * tidf) AS tfidf, sum(w * tf * tidf / greatest(len, 1)) AS docnorm, max(w * tf) AS dismax, max(tf) > 0 AS hit FROM part GROUP BY k)"""


def _top(col: str, n: int = 10) -> str:
    return f"WITH {bm25('documents', 'doc_id', 'text', TERMS)} SELECT k AS doc_id, round({col}, 6) AS score FROM scored WHERE hit ORDER BY {col} DESC, k LIMIT {n}"


def joined(spark, d):
    """Documents with the vector of the same number."""
    return table(spark, d, "documents").join(table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding"), "doc_id")


def hybrid_source(spark, d):
    from lodestone.queries.tables import schema

    s = schema("documents").add_field({"name": "embedding", "type": "vector", "attrs": {"dims": 64}})
    return S.Source(joined(spark, d), s, "doc_id")


def aggregate_hybrid(spark, d):
    q = S.AggregateHybridQuery(text="page cursor nightly run", fields="text", vector=query_vector(spark, d), vector_field="embedding", num_results=20)
    return q.run(hybrid_source(spark, d)).select("doc_id", *[F.round(c, 6).alias(c) for c in ("vector_similarity", "text_score", "hybrid_score")])


def hybrid(combination):
    def run(spark, d):
        q = S.HybridQuery(text="page cursor nightly run", fields="text", vector=query_vector(spark, d), vector_field="embedding", combination=combination, num_results=10)
        return q.run(hybrid_source(spark, d)).select("doc_id", F.round("hybrid_score", 6).alias("hybrid_score"))

    return run


J = "joined AS (SELECT d.doc_id, d.text, e.embedding::DOUBLE[] AS v FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id)"
LEGS = f"""WITH {J}, {bm25("joined", "doc_id", "text", TERMS)},
 dist AS (SELECT doc_id AS k, list_cosine_distance(v, {Q0}) AS dd FROM joined),
 tl AS (SELECT k, score, row_number() OVER (ORDER BY score DESC, k) AS r FROM scored WHERE hit ORDER BY r LIMIT 20),
 vl AS (SELECT k, (2 - dd) / 2 AS sim, row_number() OVER (ORDER BY dd, k) AS r FROM dist ORDER BY r LIMIT 20)"""


def multi(spark, d):
    s = source(spark, d, "embeddings")
    a, b = query_vector(spark, d, 0), query_vector(spark, d, 1)
    q = S.MultiVectorQuery(vectors=[S.VectorSpec(a, "embedding", 0.7, 1.2), S.VectorSpec(b, "embedding", -0.2, 1.1)], num_results=25)
    return q.run(s).select("vec_id", *[F.round(c, 6).alias(c) for c in ("distance_0", "distance_1", "score_0", "score_1", "combined_score")])


def pages(spark, d):
    index = SearchIndex(source(spark, d, "customer").schema, table(spark, d, "customer"), "c_custkey")
    got = index.query(S.FilterQuery(filter=Num("c_acctbal") > 0, sort_by=("c_acctbal", "DESC"), num_results=2_000_000_000)).offset(40).limit(20)
    return got.select("c_custkey", "c_acctbal")


def geo_distance(spark, d):
    from lodestone.functions.geo import haversine

    return table(spark, d, "users").select("user", F.round(haversine(F.col("location.lon"), F.col("location.lat"), 13.4, 52.5) / 1000, 3).alias("km"))


def tokenised(spark, d):
    return table(spark, d, "part").select("p_partkey", X.raw_tokens(F.col("p_name")).alias("tokens"))


def stems(spark, d):
    """Stems of every distinct word of the documents: stemming is done once a word, not once a text."""
    words = table(spark, d, "documents").select(F.explode(X.raw_tokens(F.col("text"))).alias("word")).distinct()
    return words.select("word", X._stem_udf()(F.array("word"))[0].alias("stem"))


def all_fields(spark, d):
    q = S.TextQuery(text="router prompt", fields={"prompt": 2.0, "response": 0.5}, num_results=15, stopwords=None, text_weights={"router": 3.0})
    s = source(spark, d, "llm_cache", df=table(spark, d, "llm_cache").dropDuplicates(["entry_id"]))
    s.schema.fields["response"].attrs["no_stem"] = True
    return q.run(s).select("entry_id", F.round("score", 6).alias("score"))


def _fields_sql() -> str:
    cache = "(SELECT entry_id, any_value(prompt) AS prompt, any_value(response) AS response FROM llm_cache GROUP BY entry_id)"
    w = {"router": 3.0}
    one = f"WITH {bm25(cache, 'entry_id', 'prompt', ['router', 'prompt'], w)} SELECT * FROM scored"
    two = f"WITH {bm25(cache, 'entry_id', 'response', ['router', 'prompt'], w)} SELECT * FROM scored"
    return f"SELECT k AS entry_id, round(coalesce(2.0 * a.score, 0) + coalesce(0.5 * b.score, 0), 6) AS score FROM ({one}) a FULL JOIN ({two}) b USING (k) WHERE coalesce(a.hit, FALSE) OR coalesce(b.hit, FALSE) ORDER BY coalesce(2.0 * a.score, 0) + coalesce(0.5 * b.score, 0) DESC, k LIMIT 15"


QUERIES = {
    "q1_filter": (lambda spark, d: S.FilterQuery(filter=Tag("o_orderstatus") == "f", return_fields=["o_totalprice"], sort_by=("o_totalprice", "DESC"), num_results=50).run(source(spark, d, "orders")), "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 50"),
    "q2_count": (lambda spark, d: S.CountQuery(Num("l_discount") >= 0.05).run(source(spark, d, "lineitem")), 'SELECT count(*) AS "count" FROM lineitem WHERE l_discount >= 0.05'),
    "q3_knn_cosine": (lambda spark, d: knn(spark, d, filter=Num("label") <= 5), f"SELECT vec_id, label, round({COS}, 6) AS vector_distance FROM embeddings WHERE label <= 5 ORDER BY {COS}, vec_id LIMIT 10"),
    "q3_knn_l2": (lambda spark, d: knn(spark, d, metric="l2", num_results=20), f"SELECT vec_id, label, round(list_distance(embedding::DOUBLE[], {Q0}), 6) AS vector_distance FROM embeddings ORDER BY list_distance(embedding::DOUBLE[], {Q0}), vec_id LIMIT 20"),
    "q3_knn_ip": (lambda spark, d: knn(spark, d, metric="ip", num_results=20), f"SELECT vec_id, label, round(1 - list_dot_product(embedding::DOUBLE[], {Q0}), 6) + 0.0 AS vector_distance FROM embeddings ORDER BY 1 - list_dot_product(embedding::DOUBLE[], {Q0}), vec_id LIMIT 20"),
    "q3_knn_sorted": (lambda spark, d: knn(spark, d, sort_by=("label", "DESC"), normalize=True), f"SELECT vec_id, label, round((2 - dd) / 2, 6) AS vector_distance FROM (SELECT vec_id, label, {COS} AS dd FROM embeddings ORDER BY dd, vec_id LIMIT 10)"),
    "q4_range": (lambda spark, d: vrange(spark, d, distance_threshold=0.9, num_results=1000), f"SELECT vec_id, round({COS}, 6) AS vector_distance FROM embeddings WHERE {COS} <= 0.9 ORDER BY {COS}, vec_id LIMIT 1000"),
    "q4_range_normalized": (lambda spark, d: vrange(spark, d, distance_threshold=0.55, normalize=True, num_results=1000), f"SELECT vec_id, round((2 - {COS}) / 2, 6) AS vector_distance FROM embeddings WHERE {COS} <= 2 - 2 * 0.55 ORDER BY {COS}, vec_id LIMIT 1000"),
    "q5_text": (lambda spark, d: text(spark, d), _top("score")),
    "q5_text_filtered": (lambda spark, d: text(spark, d, filter=Tag("kind") == "faq", n=20), f"WITH {bm25('documents', 'doc_id', 'text', TERMS)} SELECT k AS doc_id, round(score, 6) AS score FROM scored JOIN documents ON doc_id = k WHERE hit AND kind = 'faq' ORDER BY scored.score DESC, k LIMIT 20"),
    "q6_aggregate_hybrid": (aggregate_hybrid, f"WITH {J}, {bm25('joined', 'doc_id', 'text', TERMS)}, dist AS (SELECT doc_id AS k, list_cosine_distance(v, {Q0}) AS dd FROM joined ORDER BY 2, 1 LIMIT 20) SELECT dist.k AS doc_id, round((2 - dd) / 2, 6) AS vector_similarity, round(coalesce(score, 0), 6) AS text_score, round(0.3 * coalesce(score, 0) + 0.7 * (2 - dd) / 2, 6) AS hybrid_score FROM dist LEFT JOIN scored USING (k)"),
    "q7_hybrid_rrf": (hybrid("RRF"), f"{LEGS} SELECT k AS doc_id, round(coalesce(1.0 / (60 + tl.r), 0) + coalesce(1.0 / (60 + vl.r), 0), 6) AS hybrid_score FROM tl FULL JOIN vl USING (k) ORDER BY coalesce(1.0 / (60 + tl.r), 0) + coalesce(1.0 / (60 + vl.r), 0) DESC, k LIMIT 10"),
    "q7_hybrid_linear": (hybrid("LINEAR"), f"{LEGS} SELECT k AS doc_id, round(0.3 * coalesce(score, 0) + 0.7 * coalesce(sim, 0), 6) AS hybrid_score FROM tl FULL JOIN vl USING (k) ORDER BY 0.3 * coalesce(score, 0) + 0.7 * coalesce(sim, 0) DESC, k LIMIT 10"),
    "q8_multi_vector": (multi, f"SELECT vec_id, round(d0, 6) AS distance_0, round(d1, 6) AS distance_1, round((2 - d0) / 2, 6) AS score_0, round((2 - d1) / 2, 6) AS score_1, round(0.7 * (2 - d0) / 2 - 0.2 * (2 - d1) / 2, 6) AS combined_score FROM (SELECT vec_id, {COS} AS d0, {COS.replace('vec_id = 0', 'vec_id = 1')} AS d1 FROM embeddings) WHERE d0 <= 1.2 AND d1 <= 1.1 ORDER BY 0.7 * (2 - d0) / 2 - 0.2 * (2 - d1) / 2 DESC, vec_id LIMIT 25"),
    "q12_page": (pages, "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0 ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 40"),
    "q13_batch_knn": (batch, "SELECT query_id, vec_id, rank, round(d, 6) AS distance FROM (SELECT q.vec_id AS query_id, e.vec_id, list_cosine_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]) AS d, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_distance(e.embedding::DOUBLE[], q.embedding::DOUBLE[]), 12), e.vec_id)::INTEGER AS rank FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0) WHERE rank <= 10"),
    "d1_to_d7_distances": (distances, f"SELECT vec_id, round({COS}, 6) AS cosine, round(list_distance(embedding::DOUBLE[], {Q0}), 6) AS l2, round(1 - list_dot_product(embedding::DOUBLE[], {Q0}), 6) + 0.0 AS ip, round(greatest((2 - {COS}) / 2, 0), 6) AS cosine_similarity, round(1 / (1 + list_distance(embedding::DOUBLE[], {Q0})), 6) AS l2_similarity FROM embeddings"),
    "d8_geo_distance": (geo_distance, f"SELECT \"user\", round({metres('location.lon', 'location.lat', 13.4, 52.5)} / 1000, 3) AS km FROM users"),
    "t1_tokens": (tokenised, f"SELECT p_partkey, {TOKENS.format('p_name')} AS tokens FROM part"),
    "t4_field_weights": (all_fields, _fields_sql()),
    "t5_tfidf": (lambda spark, d: text(spark, d, "TFIDF"), _top("tfidf")),
    "t5_docnorm": (lambda spark, d: text(spark, d, "TFIDF.DOCNORM"), _top("docnorm")),
    "t5_dismax": (lambda spark, d: text(spark, d, "DISMAX"), _top("dismax")),
    "t5_bm25_tanh": (lambda spark, d: text(spark, d, "BM25STD.TANH", n=2_000_000_000), f"WITH {bm25('documents', 'doc_id', 'text', TERMS)} SELECT k AS doc_id, round(tanh(score / 4), 6) AS score FROM scored WHERE hit"),
    "t5_bm25_norm": (lambda spark, d: text(spark, d, "BM25STD.NORM", n=2_000_000_000), f"WITH {bm25('documents', 'doc_id', 'text', TERMS)} SELECT k AS doc_id, round(score / max(score) OVER (), 6) AS score FROM scored WHERE hit"),
    "t6_stems": (stems, None),
    "t8_optional_text": (lambda spark, d: text(spark, d, required=False), f"WITH {bm25('documents', 'doc_id', 'text', TERMS)} SELECT doc_id, round(coalesce(score, 0), 6) AS score FROM documents LEFT JOIN scored ON k = doc_id"),
    "q17_ann_cells": (cells, None),
    "q14_in_order": (lambda spark, d: text(spark, d, words="cursor nightly", in_order=True, n=2_000_000_000), f"WITH {bm25('documents', 'doc_id', 'text', ['cursor', 'nightly'])} SELECT k AS doc_id, round(score, 6) AS score FROM scored JOIN documents ON doc_id = k WHERE regexp_matches(' ' || array_to_string({TOKENS.format('text')}, ' ') || ' ', ' cursor (?:.* )?nightly ')"),
}
