"""Queries of writes, catalogs, checks, histories, caches, routers, migrations, stemmed text, built indices and streams."""

from __future__ import annotations

import time
import uuid
import warnings

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestone.functions import udf as U
from lodestone.functions import vectors as V
from lodestone.operators import caching as C
from lodestone.operators import history as H
from lodestone.operators import migration as M
from lodestone.operators import routing as R
from lodestone.operators import search as S
from lodestone.operators.ann import CellIndex, recall
from lodestone.operators.dialect import SQLQuery
from lodestone.operators.filters import Geo, Num, Tag, Text, Timestamp
from lodestone.operators.index import SearchIndex
from lodestone.operators.tools import ToolConfig, ToolServer
from lodestone.plans.physical import checkpoint_dir, remove_later, stage_table
from lodestone.queries.filtering import PADDED, TOKENS
from lodestone.queries.platform import index
from lodestone.queries.searching import K1, B, bm25
from lodestone.queries.tables import FIELDS, query_vector, schema, source
from lodestone.schema import IndexSchema
from lodestone.sources.tables import table


def folder(spark, name: str) -> str:
    """A fresh place in the shared folder."""
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    remove_later(spark, path)
    return path


def on_disk(spark, d, name: str) -> SearchIndex:
    """An index whose table lies in the shared folder, in layers."""
    out = SearchIndex(schema(name), None, FIELDS[name][0], folder(spark, name))
    out.load(table(spark, d, name))
    return out


def outcomes(spark, cases: dict[str, object]):
    """``name, outcome`` of calls: the name of the error or warning that each raises, ``none`` if it raises nothing."""

    def of(call) -> str:
        try:
            with warnings.catch_warnings(record=True) as said:
                warnings.simplefilter("always")
                call()
            return next((w.category.__name__ for w in said if issubclass(w.category, UserWarning)), "none")
        except Exception as e:  # noqa: BLE001
            return type(e).__name__

    return spark.createDataFrame([(k, of(c)) for k, c in cases.items()], "name string, outcome string")


def values(rows: list[tuple], columns: str) -> str:
    cell = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(cell, r)) + ')' for r in rows)}) t({columns})"


# ---- writes and catalog --------------------------------------------------------------------------------------------


def repeated_keys(spark, d):
    """Rows that repeat a key in one load: the last counts."""
    c = table(spark, d, "customer")
    i = index(spark, d, "customer")
    first, second = (c.where("c_nationkey = 7").withColumn("c_acctbal", F.lit(float(v))) for v in (1, 2))
    i.load(first.unionByName(second))
    return i.df.select("c_custkey", F.round("c_acctbal", 4).alias("c_acctbal"))


def layers(spark, d):
    """A table on disk after a load, an update, a drop, keys that expire and a second load; each wrote only what it changed."""
    i = on_disk(spark, d, "customer")
    i.update_by_filter(Num("c_nationkey") == 3, {"c_mktsegment": "MOVED"})
    i.drop_by_filter(Num("c_nationkey") == 4)
    i.expire_keys([str(k) for k in range(1, 40)], 0)
    i.load(table(spark, d, "customer").where("c_nationkey = 4 AND c_acctbal > 0").withColumn("c_mktsegment", F.lit("BACK")))
    return SearchIndex(i.schema, None, i.key, i.path).df.select("c_custkey", "c_mktsegment")


def preprocessed(spark, d):
    i = index(spark, d, "supplier", table(spark, d, "supplier").limit(0))
    i.load(table(spark, d, "supplier"), preprocess=lambda df: df.withColumn("s_name", F.upper("s_name")).where("s_acctbal > 0"))
    return i.df.select("s_suppkey", "s_name")


def catalog(spark, d):
    """Two indices created in a shared folder, seen and opened by name of folder as another process would."""
    root = folder(spark, "catalog")
    for name in ("nation", "region"):
        key = f"{name[0]}_{name}key"
        i = SearchIndex(IndexSchema.from_dict({"index": {"name": name}, "fields": [{"name": f"{name[0]}_name", "type": "tag"}, {"name": key, "type": "numeric"}]}), None, key, f"{root}/{name}")
        i.load(table(spark, d, name))
        i.create()
    rows = []
    for name in SearchIndex.listall(root):
        SearchIndex._catalog.pop(name, None)
        info = SearchIndex.from_existing(name, path=f"{root}/{name}").info()
        rows.append((info["name"], len(info["fields"]), info["num_docs"]))
    return spark.createDataFrame(rows, "name string, fields long, num_docs long")


def deleted(spark, d):
    i = on_disk(spark, d, "supplier")
    i.create()
    before = i.exists()
    i.delete(drop=True)
    return spark.createDataFrame([(before, i.exists())], "before boolean, after boolean")


def cleared(spark, d):
    i = on_disk(spark, d, "supplier")
    return spark.createDataFrame([(i.clear(), i.df.count())], "gone long, rest long")


def dropped_keys(spark, d):
    i = index(spark, d, "orders")
    i.drop_keys([str(k) for k in range(1, 3000)])
    return i.df.select("o_orderkey")


def expired_keys(spark, d):
    i = index(spark, d, "supplier")
    i.expire_keys([str(k) for k in range(1, 30)], 0)
    i.expire_keys([str(k) for k in range(30, 40)], 3600)
    return i.df.select("s_suppkey")


def listed_keys(spark, d):
    return spark.createDataFrame([(k,) for k in index(spark, d, "customer").keys(Num("c_acctbal") > 9000)], "c_custkey long")


def from_yaml(spark, d):
    import os
    import tempfile

    with tempfile.TemporaryDirectory() as at:  # on the driver only
        schema("users").to_yaml(os.path.join(at, "s.yaml"))
        s = IndexSchema.from_yaml(os.path.join(at, "s.yaml"))
    return spark.createDataFrame([(f.name, f.type) for f in s.fields.values()], "name string, type string")


def from_existing(spark, d):
    s = SearchIndex.from_existing("e", table(spark, d, "embeddings"), "vec_id")
    got = s.query(S.VectorQuery(vector=query_vector(spark, d), field_name="embedding", num_results=5))
    return got.select("vec_id", F.lit(s.schema.fields["embedding"].dims).alias("dims"))


def paged(spark, d):
    i = index(spark, d, "customer")
    pages = i.paginate(S.FilterQuery(filter=Num("c_acctbal") > 0, sort_by=("c_nationkey", "DESC"), return_fields=["c_nationkey"]), 100)
    rows = [(n, r["c_custkey"], r["c_nationkey"]) for n, page in zip(range(1, 5), pages) for r in page]
    return spark.createDataFrame(rows, "page long, c_custkey long, c_nationkey long")


def paged_text(spark, d):
    i = index(spark, d, "part")
    pages = i.paginate(S.TextQuery(text="small ring", fields="p_name", return_fields=[]), 70)
    return spark.createDataFrame([(n, r["p_partkey"]) for n, page in enumerate(pages, 1) for r in page], "page long, p_partkey long")


# ---- checks of operands ---------------------------------------------------------------------------------------------

OPERANDS = {
    "number against text": (lambda: Num("n") == "x", "TypeError"),
    "number against a flag": (lambda: Num("n") == True, "TypeError"),  # noqa: E712
    "tag against a number": (lambda: Tag("t") == 5, "TypeError"),
    "text against a number": (lambda: Text("t") == 5, "TypeError"),
    "geo against a number": (lambda: Geo("g") == 5, "TypeError"),
    "time against words": (lambda: Timestamp("t") == "no time", "ValueError"),
    "tag by order": (lambda: Tag("t") > "a", "ValueError"),
    "between of no kind": (lambda: Num("n").between(1, 2, "some"), "ValueError"),
    "number against a number": (lambda: Num("n") == 5, "none"),
}
KNOBS = {
    "ef on flat": ({"ef_runtime": 5}, "ValueError"),
    "policy": ({"hybrid_policy": "X"}, "ValueError"),
    "batch of none": ({"batch_size": 0}, "ValueError"),
    "history": ({"use_search_history": "MAYBE"}, "ValueError"),
    "epsilon": ({"epsilon": -1}, "ValueError"),
    "window": ({"search_window_size": 20}, "none"),
}


def operands(spark, d):
    return outcomes(spark, {k: c for k, (c, _) in OPERANDS.items()})


def knobs(spark, d):
    s, v = source(spark, d, "embeddings"), query_vector(spark, d)
    calls = {k: (lambda o=o: S.VectorQuery(vector=v, field_name="embedding", options=S.ApproximateOptions(**o)).run(s)) for k, (o, _) in KNOBS.items()}
    calls["dimensions"] = lambda: S.VectorQuery(vector=[1.0], field_name="embedding").run(s)
    calls["inner product as similarity"] = lambda: S.VectorQuery(vector=v, field_name="embedding", normalize=True).run(source(spark, d, "embeddings", "ip"))
    calls["stop words"] = lambda: SearchIndex(schema("part", stopwords=[]), table(spark, d, "part"), "p_partkey").query(S.TextQuery(text="ring", fields="p_name"))
    calls["between of a tag"] = lambda: SQLQuery("SELECT o_orderkey FROM orders WHERE o_orderstatus BETWEEN 'a' AND 'b'").run(source(spark, d, "orders"))
    return outcomes(spark, calls)


# ---- stemmed text ----------------------------------------------------------------------------------------------------

#: Words of the query below and all that share their stems in English (fixed values).
FORMS = {"return": ["return", "returns", "returned", "returning"], "candid": ["candidate", "candidates"], "stor": ["store", "stores", "stored", "storing"], "compar": ["compare", "compares", "compared", "comparing"]}


def stemmed_source(spark, d):
    s = source(spark, d, "documents")
    s.schema = schema("documents").remove_field("text").add_field({"name": "text", "type": "text"})
    return s


def stemmed(spark, d):
    q = S.TextQuery(text="comparing stored candidates returned", fields="text", num_results=25)
    return q.run(stemmed_source(spark, d)).select("doc_id", F.round("score", 6).alias("score"))


def _stemmed_sql() -> str:
    terms = ", ".join(f"('{k}', ['{chr(39).join(v).replace(chr(39), chr(39) + ', ' + chr(39))}'])" for k, v in STEMS.items())
    return f"""
WITH q(term, forms) AS (VALUES {terms}), doc AS (SELECT doc_id AS k, {TOKENS.format("text")} AS toks FROM documents),
 stat AS (SELECT count(*) AS n, avg(coalesce(len(toks), 0)) AS avgl FROM doc),
 tf AS (SELECT k, len(toks) AS len, term, len(list_filter(toks, lambda x: list_contains(forms, x)))::DOUBLE AS tf FROM doc, q WHERE toks IS NOT NULL),
 df AS (SELECT term, count(*) FILTER (WHERE tf > 0) AS df FROM tf GROUP BY 1),
 s AS (SELECT k, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * ({K1} + 1) / (tf + {K1} * (1 - {B} + {B} * len / avgl))) AS score, max(tf) > 0 AS hit FROM tf JOIN df USING (term), stat GROUP BY k)
SELECT k AS doc_id, round(score, 6) AS score FROM s WHERE hit ORDER BY s.score DESC, k LIMIT 25"""


STEMS = {"return": FORMS["return"], "candid": FORMS["candid"], "store": FORMS["stor"], "compar": FORMS["compar"]}


def stemmed_phrase(spark, d):
    return stemmed_source(spark, d).where(Text("text") == "returned the lists").select("doc_id")


def stemmed_words(spark, d):
    return stemmed_source(spark, d).where(Text("text") % "comparing candidates|storing").select("doc_id")


def stemmed_sql(spark, d):
    return SQLQuery("SELECT doc_id FROM documents WHERE text = 'nightly runs' AND n_chars > 100 LIMIT 2000000").run(stemmed_source(spark, d)).select("doc_id")


def phrase_stopwords(spark, d):
    """The default stop words of a phrase do not count, and any number of them may stand between its words."""
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return SQLQuery("SELECT p_partkey FROM part WHERE p_name = 'the small and ring' LIMIT 2000000").run(source(spark, d, "part", df=named_parts(spark, d)))


def named_parts(spark, d):
    """Parts whose names hold runs of stop words of any length."""
    p = table(spark, d, "part")
    words = F.array_join(F.transform(F.split("p_name", " "), lambda w: F.concat(w, F.expr("repeat(' of the and', CAST(p_partkey % 7 AS INT))"))), " ")
    return p.withColumn("p_name", words)


def index_stopwords(spark, d):
    """Words that the index leaves out do not stand between the others."""
    s = source(spark, d, "documents")
    s.schema = schema("documents", stopwords=["the", "of"])
    return s.where(Text("text") == "returns list candidates").select("doc_id")


# ---- built indices ---------------------------------------------------------------------------------------------------


def built_index(spark, d):
    """Ten neighbours of every 50th vector by an index of cells with 35 in 100 cells read, and the share of the true ones among them."""
    usable = table(spark, d, "sentence_vectors").where("size(embedding) = 64 AND NOT exists(embedding, x -> isnan(x)) AND exists(embedding, x -> x <> 0)")
    s = stage_table(usable.select("record_key", "embedding").dropDuplicates(["record_key"]))
    i = CellIndex.build(s, "record_key", "embedding", 64)
    asked = s.where(F.pmod(F.xxhash64("record_key"), F.lit(50)) == 0)
    near = i.search(asked, "record_key", "embedding", 10, probes=max(1, round(PROBED * len(i.centres))))
    exact = S.batch_knn(s, "record_key", "embedding", asked, "record_key", "embedding", 64, 10)
    share = recall(near, exact)
    return spark.createDataFrame([(share >= 0.9, round(share, 3))], "enough boolean, recall double").select("enough")


#: Share of the cells that is read.
PROBED = 0.35


def indexed_search(spark, d):
    """A vector query on a hnsw field: with a window that takes in all cells it is the exact one."""
    s = schema("embeddings").remove_field("embedding").add_field({"name": "embedding", "type": "vector", "attrs": {"dims": 64, "algorithm": "hnsw"}})
    i = SearchIndex(s, table(spark, d, "embeddings"), "vec_id")
    i.build_ann("embedding")
    q = S.VectorQuery(vector=query_vector(spark, d), field_name="embedding", filter=Num("label") > 2, num_results=8, options=S.ApproximateOptions(ef_runtime=1_000_000))
    return i.query(q).select("vec_id", F.round("vector_distance", 6).alias("vector_distance"))


# ---- histories, caches, routers --------------------------------------------------------------------------------------


def _history(spark, d) -> H.MessageHistory:
    chat = table(spark, d, "chat_messages").where("timestamp IS NOT NULL AND NOT isnan(timestamp) AND session_tag = 'ops-watch'")
    one = chat.groupBy("entry_id").agg(*[F.min(c).alias(c) for c in ("role", "content", "session_tag", "timestamp", "tool_call_id", "metadata")])
    return H.MessageHistory(one, "ops-watch")


def history_roles(spark, d):
    """``llm``, the old name, is assistant."""
    return _history(spark, d).get_recent(12, role="assistant").select("entry_id", "role")


def history_added(spark, d):
    h = _history(spark, d)
    h.add_message({"role": "user", "content": "one"}, now=4e15)
    h.add_message({"role": "assistant", "content": "two"}, now=5e15)
    h.drop()
    return h.get_recent(3).select("role", "content")


def history_counts(spark, d):
    h = _history(spark, d)
    n = h.count()
    h.clear()
    return spark.createDataFrame([(n, h.count(), h.messages().count())], "n long, rest long, shown long")


def history_context(spark, d):
    rows = H.as_context(_history(spark, d).get_recent(20, role=["system", "tool"]))
    return spark.createDataFrame([(r["role"], r["content"], r.get("tool_call_id")) for r in rows], "role string, content string, tool_call_id string")


def cache_upkeep(spark, d):
    """Cached answers with a filterable field after an update and drops."""
    c = table(spark, d, "llm_cache").where("size(prompt_vector) = 64").groupBy("entry_id").agg(*[F.min(n).alias(n) for n in ("prompt", "response", "prompt_vector", "inserted_at", "updated_at", "metadata")])
    c = c.withColumn("lang", F.when(F.substring("entry_id", 1, 1) < "8", "en").otherwise("de"))
    cache = C.SemanticCache(SearchIndex(C.cache_schema("c", 64, [{"name": "lang", "type": "tag"}]), c, "entry_id"), 0.3)
    ids = [r[0] for r in c.select("entry_id").orderBy("entry_id").limit(3).collect()]
    cache.update(ids[0], now=5.0, response="new")
    cache.drop(ids[1:])
    return cache.index.query(S.FilterQuery(filter=Tag("lang") == "en", num_results=1_000_000)).select("entry_id", "response", "updated_at")


def cache_batch(spark, d):
    s = table(spark, d, "sentence_vectors").where("sentence IS NOT NULL").groupBy("sentence").agg(F.min("embedding").alias("embedding"))
    stored = s.select(F.col("sentence").alias("content"), F.lit("m").alias("model_name"), "embedding", F.lit("x").alias("metadata"))
    cache = C.EmbeddingsCache(stored.limit(0).withColumn("entry_id", F.lit("")), ttl=3600)
    cache.mset(stored)
    keys = [r[0] for r in cache.index.df.select("entry_id").orderBy("entry_id").limit(4).collect()]
    wanted = [keys[2], "absent", keys[0], keys[2]]
    got, there = cache.mget_by_keys(wanted), cache.mexists_by_keys(wanted)
    return spark.createDataFrame([(k, r["content"] if r else None, t) for k, (r, t) in enumerate(zip(got, there), 1)], "place long, content string, there boolean")


def router_kept(spark, d):
    """A router that was saved and opened again needs no embedding."""
    refs = table(spark, d, "router_references").select(F.lower("route_name").alias("route_name"), "reference", "vector", "distance_threshold").distinct().orderBy("route_name", "reference").collect()
    by = {(r["reference"]): list(r["vector"]) for r in refs}
    names = sorted({r["route_name"] for r in refs})
    routes = [R.Route(n, list(dict.fromkeys(r["reference"] for r in refs if r["route_name"] == n)), {}, 0.5) for n in names]
    at = folder(spark, "router")
    R.SemanticRouter("r", routes, by.__getitem__, spark=spark).save(at)

    def no(_: str):
        raise ValueError("embedded again")

    got = R.SemanticRouter.from_existing(at, no, spark)
    return got.references().select("route_name", "reference")


def tool_search(spark, d):
    t = ToolServer(embed=lambda q: query_vector(spark, d))
    t.register("near", index(spark, d, "embeddings"), ToolConfig(mode="vector", vector_field="embedding"))
    got = t.search_records("near", "any", limit=5, offset=5, filter={"field": "label", "op": "gt", "value": 2})
    return spark.createDataFrame([(r["vec_id"], round(r["vector_distance"], 6)) for r in got["results"]], "vec_id long, similarity double")


# ---- migration ---------------------------------------------------------------------------------------------------------


@F.pandas_udf(T.BinaryType())
def _pack(s: pd.Series) -> pd.Series:
    return s.map(lambda v: V.to_bytes(v, "float32"))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def _unpack(s: pd.Series) -> pd.Series:
    return s.map(lambda b: [float(x) for x in V.from_bytes(bytes(b), "float64")])


def converted_values(spark, d):
    """Through bytes of float32 and float64 and back: every value stays."""
    e = table(spark, d, "embeddings").select("vec_id", _pack("embedding").alias("b"))
    return V.convert(e, "b", "float32", "float64").select("vec_id", _unpack("b").alias("v"))


def _migratable(spark, d):
    a = IndexSchema.from_dict({"index": {"name": "e", "prefix": "old"}, "fields": [{"name": "label", "type": "numeric"}, {"name": "embedding", "type": "vector", "attrs": {"dims": 64}}]})
    i = SearchIndex(a, None, "key", folder(spark, "m"))
    i.load(table(spark, d, "embeddings").withColumn("key", F.concat(F.lit("old:"), F.col("vec_id").cast("string"))).drop("vec_id"))
    b, renames = M.merge(a, {"index": {"prefix": "new"}, "rename_fields": [{"old_name": "label", "new_name": "topic"}], "update_fields": [{"name": "embedding", "attrs": {"datatype": "int8"}}]})
    return i, b, M.plan(a, b, renames)


def migrated_int8(spark, d):
    i, b, p = _migratable(spark, d)
    result = M.Migrator(spark, i.path).apply(p)
    if not result.passed:
        raise ValueError(f"the migration failed: {result.failures}")
    return SearchIndex(b, None, "key", i.path).df.select("key", "topic", F.col("embedding").cast("array<int>").alias("q"))


def rolled_back(spark, d):
    i, b, p = _migratable(spark, d)
    m = M.Migrator(spark, i.path)
    again = M.apply_all([(m, p)]) + M.apply_all([(m, p)])
    m.rollback()
    df = SearchIndex(i.schema, None, "key", i.path).df
    return df.select("key", "label", F.lit(again[0].passed and again[1] is None).alias("once"))


def plan_kinds(spark, d):
    a = schema("users")
    patches = {
        "rename": {"rename_fields": [{"old_name": "job", "new_name": "work"}]}, "quantise": {"update_fields": [{"name": "user_embedding", "attrs": {"datatype": "float16"}}]}, "remove": {"remove_fields": ["age"]},
        "other dims": {"update_fields": [{"name": "user_embedding", "attrs": {"dims": 9}}]}, "new vector": {"add_fields": [{"name": "w", "type": "vector", "attrs": {"dims": 2}}]}, "other storage": {"index": {"storage_type": "json"}},
    }
    return spark.createDataFrame([(k, M.plan(a, *M.merge(a, p)).supported) for k, p in patches.items()], "patch string, supported boolean")


def disk(spark, d):
    n = table(spark, d, "embeddings").count()
    e = M.disk_estimate(n, 64, "float32", "int8")
    return spark.createDataFrame([(e["before"], e["after"], e["saved"], e["backup"])], "before long, after long, saved long, backup long")


# ---- plug-ins ------------------------------------------------------------------------------------------------------------


def embedded_once(spark, d):
    """Names embedded through a cache: each distinct one is embedded once, also over two calls."""
    cache = C.EmbeddingsCache(spark.createDataFrame([], C.EmbeddingsCache.SCHEMA))
    v = U.CustomVectorizer(lambda t: [float(len(t)), 1.0], model="m")
    part = table(spark, d, "part").select("p_partkey", "p_name")
    U.embed_with_cache(part.where("p_partkey % 2 = 0"), "p_name", "v", v, cache)
    out = U.embed_with_cache(part, "p_name", "v", v, cache)
    return out.groupBy("v").agg(F.count("*").alias("n")).select(F.col("v")[0].alias("length"), "n")


# ---- streams ---------------------------------------------------------------------------------------------------------------


def late_rows(spark, d):
    """Daily counts in append mode: rows that come more than two days late are left out, the rest are counted in their day."""
    from lodestone.streaming.ingest import windowed_counts

    e = table(spark, d, "events")
    path = folder(spark, "late")
    cut, old = F.lit("2024-01-20").cast("timestamp_ntz"), F.lit("2024-01-03").cast("timestamp_ntz")
    e.where(F.col("ts") < cut).coalesce(1).write.parquet(path)
    # files are taken in order of time; the bound of lateness that a batch sees is that of the one before the last
    for part in (e.where(F.col("ts") >= cut), e.where(F.col("ts") < old)):
        time.sleep(1.1)
        part.coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(path).withColumn("t", F.col("ts").cast("timestamp"))
    out = folder(spark, "counts")
    q = windowed_counts(stream, "t", "1 day", "2 days", ["event_type"]).writeStream.format("parquet").outputMode("append").option("checkpointLocation", folder(spark, "offsets")).trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.parquet(out).select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def streamed_once(spark, d):
    """Events that are delivered twice, written into an index on disk once."""
    from lodestone.streaming.ingest import deduplicated, upsert_into

    e = table(spark, d, "events").select("event_id", "ts", "event_type")
    path = folder(spark, "twice")
    e.unionByName(e).repartition(2).write.parquet(path)
    stream = spark.readStream.schema(e.schema).parquet(path).withColumn("t", F.col("ts").cast("timestamp"))
    s = IndexSchema.from_dict({"index": {"name": "once"}, "fields": [{"name": "event_type", "type": "tag"}]})
    i = SearchIndex(s, None, "event_id", folder(spark, "once"))
    upsert_into(i, deduplicated(stream, "event_id", "t", "40 days").select("event_id", "event_type"), folder(spark, "seen")).awaitTermination()
    return i.df.groupBy("event_type").agg(F.count("*").alias("n"))


def sliding(spark, d):
    """Windows of two days that slide by one, over the batch as over a stream."""
    from lodestone.streaming.ingest import windowed_counts

    e = table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return windowed_counts(e, "t", "2 days", "1 day", ["event_type"], "1 day").select(F.date_format("window.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def sessions(spark, d):
    """Visits of each user: rows at most an hour apart."""
    from lodestone.streaming.ingest import session_counts

    e = table(spark, d, "events").withColumn("t", F.col("ts").cast("timestamp"))
    return session_counts(e, "t", "1 hour", "1 day", ["user_id"]).groupBy("user_id").agg(F.count("*").alias("visits"), F.max("n").alias("longest"))


HIST = "(SELECT entry_id, min(role) AS role, min(content) AS content, min(timestamp) AS timestamp, min(tool_call_id) AS tool_call_id FROM chat_messages WHERE timestamp IS NOT NULL AND NOT isnan(timestamp) AND session_tag = 'ops-watch' GROUP BY entry_id)"
ANY = "len(list_filter({0}, lambda x: list_contains({1}, x))) > 0"
TOK = TOKENS.format("text")
FINE = "len(vector_field) = 64 AND NOT list_bool_or(list_transform(vector_field, lambda x: isnan(x))) AND list_bool_or(list_transform(vector_field, lambda x: x <> 0))"
ONE_CACHE = "(SELECT entry_id, min(response) AS response, min(updated_at) AS updated_at FROM llm_cache WHERE len(prompt_vector) = 64 GROUP BY entry_id)"
COS0 = "list_cosine_distance(embedding::DOUBLE[], (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0))"
PAGES = "SELECT ((row_number() OVER (ORDER BY c_nationkey DESC, c_custkey) - 1) // 100 + 1)::BIGINT AS page, c_custkey, c_nationkey::BIGINT AS c_nationkey FROM customer WHERE c_acctbal > 0 QUALIFY page <= 4"
INT8 = "list_transform(embedding, lambda x: (CASE WHEN hi > lo THEN round_even((x::DOUBLE - lo) / (hi - lo) * 255, 0) - 128 ELSE 0 END)::INTEGER)"

QUERIES = {
    "s2_last_of_repeated_keys": (repeated_keys, "SELECT c_custkey, round(CASE WHEN c_nationkey = 7 THEN 2 ELSE c_acctbal END, 4) AS c_acctbal FROM customer"),
    "s2_layers_on_disk": (layers, "SELECT c_custkey, CASE WHEN c_nationkey = 3 THEN 'MOVED' WHEN c_nationkey = 4 THEN 'BACK' ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE CASE WHEN c_nationkey = 4 THEN c_acctbal > 0 ELSE c_custkey NOT BETWEEN 1 AND 39 END"),
    "s3_preprocess": (preprocessed, "SELECT s_suppkey, upper(s_name) AS s_name FROM supplier WHERE s_acctbal > 0"),
    "s5_s13_catalog": (catalog, "SELECT 'nation' AS name, 2::BIGINT AS fields, count(*) AS num_docs FROM nation UNION ALL SELECT 'region', 2, count(*) FROM region"),
    "s6_delete": (deleted, "SELECT TRUE AS before, FALSE AS after"),
    "s7_clear": (cleared, "SELECT count(*) AS gone, 0::BIGINT AS rest FROM supplier"),
    "s8_drop_keys": (dropped_keys, "SELECT o_orderkey FROM orders WHERE o_orderkey NOT BETWEEN 1 AND 2999"),
    "s9_expire_keys": (expired_keys, "SELECT s_suppkey FROM supplier WHERE s_suppkey NOT BETWEEN 1 AND 29"),
    "s12_keys": (listed_keys, "SELECT c_custkey FROM customer WHERE c_acctbal > 9000"),
    "s14_from_existing": (from_existing, f"SELECT vec_id, 64 AS dims FROM embeddings ORDER BY {COS0}, vec_id LIMIT 5"),
    "s17_yaml": (from_yaml, values([(n, t) for n, t, _ in FIELDS["users"][1]], "name, type")),
    "f19_operand_checks": (operands, values([(k, o) for k, (_, o) in OPERANDS.items()], "name, outcome")),
    "q15_q16_d7_l26_checks": (knobs, values([(k, o) for k, (_, o) in KNOBS.items()] + [("dimensions", "ValueError"), ("inner product as similarity", "UserWarning"), ("stop words", "UserWarning"), ("between of a tag", "ValueError")], "name, outcome")),
    "q12_paginate": (paged, PAGES),
    "q12_paginate_scored": (paged_text, f"WITH {bm25('part', 'p_partkey', 'p_name', ['small', 'ring'])} SELECT ((row_number() OVER (ORDER BY round(score, 9) DESC, k) - 1) // 70 + 1)::BIGINT AS page, k AS p_partkey FROM scored WHERE hit"),
    "q5_text_stemmed": (stemmed, _stemmed_sql()),
    "f7_phrase_stemmed": (stemmed_phrase, f"SELECT doc_id FROM documents WHERE regexp_matches({PADDED.format('text')}, ' return(s|ed|ing)? the list(s|ed|ing)? ')"),
    "f9_words_stemmed": (stemmed_words, f"SELECT doc_id FROM documents WHERE {ANY.format(TOK, FORMS['compar'])} AND {ANY.format(TOK, FORMS['candid'] + FORMS['stor'])}"),
    "l5_phrase_stemmed": (stemmed_sql, f"SELECT doc_id FROM documents WHERE regexp_matches({PADDED.format('text')}, ' nightly run(s|ning)? ') AND n_chars > 100"),
    "l5_phrase_stop_words": (phrase_stopwords, f"SELECT p_partkey FROM part WHERE contains({PADDED.format('p_name')}, ' small ring ')"),
    "t7_index_stopwords": (index_stopwords, f"SELECT doc_id FROM documents WHERE contains(' ' || array_to_string(list_filter({TOK}, lambda x: x <> 'the' AND x <> 'of'), ' ') || ' ', ' returns list candidates ')"),
    "q17_built_index": (built_index, "SELECT TRUE AS enough"),
    "q17_indexed_search": (indexed_search, f"SELECT vec_id, round({COS0}, 6) AS vector_distance FROM embeddings WHERE label > 2 ORDER BY {COS0}, vec_id LIMIT 8"),
    "e10_history_roles": (history_roles, f"SELECT entry_id, role FROM {HIST} WHERE role IN ('assistant', 'llm') ORDER BY timestamp DESC, entry_id DESC LIMIT 12"),
    "e7_history_added": (history_added, f"SELECT * FROM (SELECT role, content FROM {HIST} ORDER BY timestamp DESC, entry_id DESC LIMIT 2) UNION ALL SELECT 'user', 'one'"),
    "e9_history_counts": (history_counts, f"SELECT count(*) AS n, 0::BIGINT AS rest, 0::BIGINT AS shown FROM {HIST}"),
    "e11_history_context": (history_context, f"SELECT role, content, nullif(tool_call_id, '') AS tool_call_id FROM {HIST} WHERE role IN ('system', 'tool') ORDER BY timestamp DESC, entry_id DESC LIMIT 20"),
    "e3_e4_cache_upkeep": (cache_upkeep, f"SELECT entry_id, CASE WHEN r = 1 THEN 'new' ELSE response END AS response, CASE WHEN r = 1 THEN 5.0 ELSE updated_at END AS updated_at FROM (SELECT *, row_number() OVER (ORDER BY entry_id) AS r FROM {ONE_CACHE}) WHERE r NOT IN (2, 3) AND substr(entry_id, 1, 1) < '8'"),
    "e5_cache_batch": (cache_batch, "WITH k AS (SELECT sentence, row_number() OVER (ORDER BY sha256(sentence || ':m')) AS r FROM (SELECT DISTINCT sentence FROM sentence_vectors WHERE sentence IS NOT NULL)) SELECT * FROM (VALUES (1::BIGINT, (SELECT sentence FROM k WHERE r = 3), TRUE), (2, NULL, FALSE), (3, (SELECT sentence FROM k WHERE r = 1), TRUE), (4, (SELECT sentence FROM k WHERE r = 3), TRUE)) t(place, content, there)"),
    "e15_router_kept": (router_kept, "SELECT DISTINCT lower(route_name) AS route_name, reference FROM router_references"),
    "tool_search": (tool_search, f"SELECT vec_id, round((2 - dd) / 2, 6) AS similarity FROM (SELECT vec_id, {COS0} AS dd FROM embeddings WHERE label > 2 ORDER BY dd, vec_id LIMIT 5 OFFSET 5)"),
    "m2_convert_values": (converted_values, "SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings"),
    "m7_migration_int8": (migrated_int8, f"SELECT 'new:' || vec_id AS key, label AS topic, {INT8} AS q FROM (SELECT *, list_min(embedding)::DOUBLE AS lo, list_max(embedding)::DOUBLE AS hi FROM embeddings)"),
    "m8_m10_rollback": (rolled_back, "SELECT 'old:' || vec_id AS key, label, TRUE AS once FROM embeddings"),
    "m6_plan_kinds": (plan_kinds, values([("rename", True), ("quantise", True), ("remove", True), ("other dims", False), ("new vector", False), ("other storage", False)], "patch, supported")),
    "m11_disk": (disk, "SELECT count(*) * 256 AS before, count(*) * 64 AS after, count(*) * 192 AS saved, count(*) * 256 AS backup FROM embeddings"),
    "u4_embed_with_cache": (embedded_once, "SELECT length(p_name)::DOUBLE AS length, count(*) AS n FROM part GROUP BY 1"),
    "st_late_rows": (late_rows, "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 2 DAY FROM events) GROUP BY 1, 2"),
    "st_once": (streamed_once, "SELECT event_type, count(*) AS n FROM events GROUP BY 1"),
    "st_sliding": (sliding, "SELECT strftime(s, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM (SELECT event_type, unnest([date_trunc('day', ts), date_trunc('day', ts) - INTERVAL 1 DAY]) AS s FROM events) GROUP BY 1, 2"),
    "st_sessions": (sessions, "SELECT user_id, count(*) AS visits, max(n) AS longest FROM (SELECT user_id, v, count(*) AS n FROM (SELECT user_id, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS v FROM (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh FROM events)) GROUP BY 1, 2) GROUP BY 1"),
}
