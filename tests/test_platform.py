import datetime as dt
import time

import numpy as np
import pytest

from lodestone.functions import text as X
from lodestone.functions import udf as U
from lodestone.functions import vectors as V
from lodestone.operators import caching as C
from lodestone.operators import history as H
from lodestone.operators import migration as M
from lodestone.operators import routing as R
from lodestone.operators import search as S
from lodestone.operators.filters import Num, Tag
from lodestone.operators.index import SearchIndex
from lodestone.operators.tools import ToolConfig, ToolServer
from lodestone.schema import Field, IndexSchema, SchemaError
from tests.fixtures import SCHEMA, crew, tools


def test_schema(tmp_path, spark):
    s = IndexSchema.from_dict(SCHEMA)
    s.to_yaml(str(tmp_path / "s.yaml"))
    assert IndexSchema.from_yaml(str(tmp_path / "s.yaml")).to_dict() == s.to_dict()
    assert s.index.key("7") == "c:7" and IndexSchema.from_dict({"index": {"name": "x", "prefix": "a:::"}}).index.key("7") == "a:7"
    assert "years" not in s.remove_field("years").fields
    for bad in ({"name": "years", "type": "numeric"}, {"name": "v", "type": "vector", "attrs": {}}, {"name": "v", "type": "nope"}, {"name": "v", "type": "vector", "attrs": {"dims": 8, "algorithm": "svs-vamana", "reduce": 4}}, {"name": "v", "type": "vector", "attrs": {"dims": 8, "algorithm": "svs-vamana", "compression": "LeanVec4x8", "reduce": 8}}, {"name": "v", "type": "vector", "attrs": {"dims": 8, "datatype": "int8", "algorithm": "svs-vamana"}}):
        with pytest.raises(SchemaError):
            s.add_field(bad)
    assert Field("h", "vector", None, {"dims": 3, "algorithm": "hnsw"}).m == 16
    df = spark.createDataFrame([("1.5", "1.0,2.0", "word", ["a"], 3)], "a string, g string, t string, tags array<string>, n int")
    assert {f["name"]: f["type"] for f in s.generate_fields(df)} == {"a": "numeric", "g": "geo", "t": "text", "tags": "tag", "n": "numeric"}


def test_validation_names_what_is_wrong(spark):
    s = IndexSchema.from_dict(SCHEMA)
    df = spark.createDataFrame([("x", "5", [1.0, 2.0]), ("y", "no", [1.0, 2.0, 3.0])], "name string, years string, skills array<float>")
    got = {r.name: r._errors for r in s.errors(df).collect()}
    assert got == {"x": ["skills: expected 3 dimensions"], "y": ["years: not a number"]}
    with pytest.raises(Exception, match="expected 3 dimensions|not a number"):
        s.validated(df).collect()


def test_load_update_drop_expire(spark):
    index = crew(spark)
    row = index.fetch("bruno").asDict(recursive=True)
    assert index.load([{**row, "years": 23}, {**row, "name": "new"}]) == 2
    assert index.df.count() == 9 and index.fetch("bruno").years == 23
    assert index.update_by_filter(Num("years") > 40, {"grade": "junior"}, dry_run=True).matched == 2
    assert index.update_by_filter(Num("years") > 40, {"grade": "junior", "trade": None}).processed == 2
    assert index.query(S.CountQuery(Tag("grade") == "junior")) == 4 and index.fetch("gil").trade is None
    index.update_by_filter(Num("years") == 12, {"port": {"lat": 1.0}})
    assert index.fetch("emre").port.lat == 1.0 and index.fetch("emre").port.lon == -77.03
    with pytest.raises(ValueError):
        index.drop_by_filter(Tag("grade") == [])
    assert index.drop_by_filter(Num("years") < 7).matched == 2
    assert index.drop_keys("new") == 1
    index.expire_keys("hana", 0)
    assert index.fetch("hana") is None and index.expire_keys(["fumi"], 100) == 0
    assert sorted(index.keys(Num("years") >= 8)) == ["bruno", "dora", "emre", "gil"]
    index.clear()
    assert index.df.count() == 0


def test_catalog(spark):
    index = crew(spark)
    assert index.create() and not index.create() and index.create(overwrite=True)
    assert SearchIndex.listall() == ["crew"] and index.exists() and SearchIndex.from_existing("crew") is index
    assert index.info()["num_docs"] == 8 and index.stats()["num_terms"] > 20 and index.stats()["max_doc_id"] is None
    index.delete(drop=False)
    assert not index.exists()
    assert SearchIndex.from_existing("t", index.df, "name").schema.fields["years"].type == "numeric"


def test_versions_on_disk_and_migration(spark, tmp_path):
    path = str(tmp_path / "table")
    (tmp_path / "table").mkdir()
    a = IndexSchema.from_dict({"index": {"name": "t", "prefix": "old"}, "fields": [{"name": "n", "type": "numeric"}, {"name": "v", "type": "vector", "attrs": {"dims": 2}}]})
    index = SearchIndex(a, None, "key", path)
    index.load([{"id": str(k), "n": k, "v": [float(k), 1.0]} for k in range(5)], id_field="id")
    b, renames = M.merge(a, {"index": {"prefix": "new"}, "rename_fields": [{"old_name": "n", "new_name": "m"}], "update_fields": [{"name": "v", "attrs": {"datatype": "float16"}}]})
    p = M.plan(a, b, renames)
    assert p.supported and p.renamed == {"n": "m"} and p.quantised == {"v": ("float32", "float16")}
    m = M.Migrator(spark, path)
    assert m.apply(p).passed
    assert sorted(r.key for r in SearchIndex(b, None, "key", path).df.collect()) == [f"new:{k}" for k in range(5)]
    assert M.apply_all([(m, p)]) == [None] and len(m.status()) == 1
    m.rollback()
    assert "n" in SearchIndex(a, None, "key", path).df.columns


def test_plan_blocks():
    a = IndexSchema.from_dict(SCHEMA)
    cases = [{"update_fields": [{"name": "photo", "attrs": {"dims": 9}}]}, {"add_fields": [{"name": "w", "type": "vector", "attrs": {"dims": 2}}]}, {"index": {"key_separator": "/"}}, {"index": {"storage_type": "json"}}, {"remove_fields": ["years"], "add_fields": [{"name": "years", "type": "tag"}]}]
    for patch in cases:
        assert not M.plan(a, M.merge(a, patch)[0]).supported
    assert M.plan(a, M.merge(a, {"remove_fields": ["years"], "add_fields": [{"name": "served", "type": "numeric"}]})[0]).warnings
    with pytest.raises(ValueError):
        M.merge(a, {"remove_fields": ["nope"]})
    assert M.disk_estimate(1000, 768, "float32", "float16")["saved"] == 1000 * 768 * 2


def test_compression():
    assert M.recommend(1536, "memory") == {"algorithm": "svs-vamana", "datatype": "float16", "compression": "LeanVec4x8", "reduce": 768, "graph_max_degree": 64, "construction_window_size": 300, "search_window_size": 20}
    assert M.recommend(384, "memory")["compression"] == "LVQ4"
    assert [M.memory_savings(*x) for x in (("LVQ4", 384), ("LVQ4x4", 768), ("LeanVec4x8", 1536, 768), ("LeanVec4x8", 1536), ("LeanVec8x8", 1536, 768), ("none", 10))] == [87.5, 75.0, 81.2, 62.5, 75.0, 0.0]
    with pytest.raises(ValueError):
        M.recommend(0)


def test_bytes_and_quantisation(spark):
    v = [0.5, -1.25, 3.0]
    for t in ("float16", "float32", "float64", "bfloat16"):
        assert V.from_bytes(V.to_bytes(v, t), t) == v and t in V.datatype_of(len(V.to_bytes(v, t)), 3)
    df = spark.createDataFrame([(0, [0.0, 0.5, 1.0]), (1, [2.0, 2.0, 2.0])], "k int, v array<float>")
    assert [r.q for r in df.select("k", V.quantise(df.v, "int8").alias("q")).orderBy("k").collect()] == [[-128, 0, 127], [0, 0, 0]]
    b = spark.createDataFrame([(bytearray(V.to_bytes(v, "float32")),), (None,)], "b binary")
    assert [r.b and V.from_bytes(bytes(r.b), "float16") for r in V.convert(b, "b", "float32", "float16").collect()] == [v, None]
    long = spark.createDataFrame([([float(k) for k in range(40)],)], "v array<float>")
    want = float(np.arange(40) @ np.arange(40))
    assert long.select(V.dot(long.v, list(range(40)))).first()[0] == want and long.select(V.l2_distance(long.v, [0.0] * 40, squared=True)).first()[0] == want
    assert long.select(V.dot(long.v, [1.0, 2.0])).first()[0] is None
    with pytest.warns(UserWarning):
        V.normalised("ip", long.v[0])


@pytest.mark.parametrize("word,root", [("caresses", "caress"), ("ponies", "poni"), ("cats", "cat"), ("agreed", "agre"), ("plastered", "plaster"), ("motoring", "motor"), ("hopping", "hop"), ("filing", "file"), ("happy", "happi"), ("relational", "relat"), ("hopefulness", "hope"), ("adjustment", "adjust"), ("adoption", "adopt"), ("rate", "rate"), ("controll", "control"), ("masts", "mast"), ("climbing", "climb")])
def test_stems(word, root):
    assert X.stem(word) == root


def test_semantic_cache(spark):
    rows = spark.createDataFrame([("k0", "old", "r", [1.0, 0.0], 0.0, 0.0, "", "en")], "entry_id string, prompt string, response string, prompt_vector array<float>, inserted_at double, updated_at double, metadata string, lang string")
    cache = C.SemanticCache(SearchIndex(C.cache_schema("c", 2, [{"name": "lang", "type": "tag"}]), rows, "entry_id"), 0.05, ttl=100)
    key = cache.store("What is it?", "A cache.", [0.0, 1.0], {"a": 1}, {"lang": "de"}, now=5.0)
    assert key == C.entry_id("What is it?", {"lang": "de"})
    assert [r["response"] for r in cache.check([0.05, 1.0])] == ["A cache."]
    assert cache.check([0.05, 1.0], filter=Tag("lang") == "en") == [] and cache.check([1.0, 1.0]) == []
    assert cache.check([0.0, 1.0], distance_threshold=0)
    cache.update(key, now=9.0, response="Better.")
    assert cache.check([0.0, 1.0])[0]["response"] == "Better."
    with pytest.raises(ValueError):
        cache.update(key, nope=1)
    with pytest.raises(ValueError):
        C.cache_schema("c", 2, [{"name": "prompt", "type": "tag"}])
    with pytest.raises(ValueError):
        cache.set_threshold(3)
    assert cache.drop([key]) == 1 and C.service_similarity(0.2) == 0.8 and C.service_similarity(0.2, True) == 0.9
    cache.clear()
    assert cache.check([1.0, 0.0]) == []


def test_embeddings_cache_and_vectorizer(spark):
    calls = []
    v = U.CustomVectorizer(lambda t: [float(len(t)), 1.0], model="m")
    cache = C.EmbeddingsCache(spark.createDataFrame([], C.EmbeddingsCache.SCHEMA))
    df = spark.createDataFrame([("aa",), ("b",), ("aa",), (None,)], "t string")
    for _ in range(2):
        got = U.embed_with_cache(df, "t", "v", v, cache).collect()
        assert sorted((r.t or "", r.v and r.v[0]) for r in got) == [("", None), ("aa", 2.0), ("aa", 2.0), ("b", 1.0)]
    assert cache.exists("aa", "m") and cache.get("aa", "m")["embedding"] == [2.0, 1.0] and cache.get("zz", "m") is None
    assert cache.drop("aa", "m") == 1 and not cache.exists("aa", "m")
    wanted = spark.createDataFrame([("b", "m"), ("q", "m")], "content string, model_name string")
    assert sorted((r.content, r.found) for r in cache.mexists(wanted).collect()) == [("b", True), ("q", False)]
    cache.mdrop(wanted)
    assert cache.index.df.count() == 0 and not calls
    assert v.embed_many(["a", "bb"], 1) == [[1.0, 1.0], [2.0, 1.0]] and list(U.batchify([1, 2, 3], 2)) == [[1, 2], [3]]
    with pytest.raises(TypeError):
        v.embed(5)
    with pytest.raises(ValueError):
        U.CustomVectorizer(lambda t: "no")
    with pytest.raises(NotImplementedError):
        U.provider("any")


def test_history(spark):
    h = H.MessageHistory(session="s", spark=spark)
    h.store("first", "answer", now=1.0)
    h.add_message({"role": "tool", "content": "result", "tool_call_id": "c", "metadata": {"x": 1}}, now=2.0)
    h.add_message({"role": "user", "content": "other"}, session="t", now=3.0)
    assert H.as_context(h.get_recent(2), as_text=True) == ["answer", "result"]
    assert H.as_context(h.get_recent(1)) == [{"role": "tool", "content": "result", "tool_call_id": "c", "metadata": {"x": 1}}]
    assert h.count() == 3 and h.get_recent(5, role=["user"]).count() == 1 and h.get_recent(0).count() == 0
    for bad in ([], "boss", ["boss"], 5):
        with pytest.raises(ValueError):
            h.get_recent(1, role=bad)
    with pytest.raises(ValueError):
        h.get_recent(-1)
    h.drop()
    assert H.as_context(h.messages(), True) == ["first", "answer"]
    h.clear()
    assert h.count() == 0 and h.count("t") == 1


def test_router(spark, tmp_path):
    table = {"hello": [1.0, 0.0], "hi": [0.9, 0.1], "bye": [0.0, 1.0], "goodbye": [0.1, 0.9]}
    r = R.SemanticRouter("r", [R.Route("greeting", ["hello", "hi"], distance_threshold=0.3), R.Route("farewell", ["bye", "goodbye"], distance_threshold=0.2)], table.__getitem__, spark=spark)
    assert r("hello").name == "greeting" and r(vector=[0.0, 1.0]).name == "farewell" and r(vector=[-1.0, -1.0]).name is None
    mid = r.route_many(vector=[1.0, 1.0], max_k=2)
    assert [m.name for m in mid] == ["greeting"] and 0.2 < mid[0].distance < 0.3  # 0.24 is not below farewell's own threshold
    assert r.route_many(vector=[1.0, 0.02], aggregation="min")[0].distance < r.route_many(vector=[1.0, 0.02])[0].distance
    r.to_yaml(str(tmp_path / "r.yaml"))
    again = R.SemanticRouter.from_yaml(str(tmp_path / "r.yaml"), table.__getitem__, spark)
    assert again.to_dict() == r.to_dict()
    assert r.delete_route_references("farewell", ["bye"]) == 1 and r.get_route_references("farewell").count() == 1
    r.update_route_thresholds({"farewell": 1.0})
    r.remove_route("greeting")
    assert r.get("greeting") is None
    for bad in (lambda: R.Route("x", []), lambda: R.Route("x", ["a"], distance_threshold=0), lambda: R.RoutingConfig(0), lambda: R.RoutingConfig(1, "max"), lambda: r.route_many()):
        with pytest.raises(ValueError):
            bad()


def test_tools(spark):
    t = ToolServer(embed=lambda q: [0.9, 0.2, 0.1])
    t.register("people", crew(spark), ToolConfig(mode="fulltext", text_field="note"))
    t.register("near", crew(spark), ToolConfig(mode="vector", vector_field="skills", max_limit=5))
    t.register("both", crew(spark), ToolConfig(mode="hybrid", text_field="note", vector_field="skills", linear_text_weight=0.3))
    assert [x["id"] for x in t.list_indexes()] == ["both", "near", "people"]
    assert len(t.search_records("people", "ropes", filter={"field": "years", "op": "lt", "value": 20})["results"]) == 2
    assert [r["name"] for r in t.search_records("near", "x", limit=1, offset=1)["results"]] == ["chidi"]
    assert len(t.search_records("both", "ropes")["results"]) == 8
    for bad in ({"limit": 6}, {"limit": 0}, {"offset": -1}, {"offset": 1000}):
        with pytest.raises(ValueError):
            t.search_records("near", "x", **bad)
    with pytest.raises(ValueError):
        t.upsert_records("near", [])


def test_sql(spark):
    p = tools(spark)
    names = lambda sql, **kw: [r[0] for r in p.sql(sql, kw).collect()]
    assert names("SELECT title FROM tools WHERE category = 'reading' AND price < 30") == ["Rose growing handbook"]
    assert len(names("SELECT title FROM tools WHERE tags IN ('heavy')")) == 2
    assert names("SELECT title FROM tools WHERE (category = 'reading' OR category = 'watering') AND rating > 4.2 ORDER BY price DESC") == ["Copper watering can", "Soil chemistry primer", "Rose growing handbook"]
    assert names("SELECT COUNT(*) AS n FROM tools WHERE title LIKE 'prun%'") == [3]
    assert [tuple(r) for r in p.sql("SELECT category, COUNT(*) AS n, MAX(price) AS m FROM tools WHERE price > 10 GROUP BY category ORDER BY m DESC").collect()] == [("cutting", 3, 74.0), ("watering", 2, 48.0), ("reading", 2, 39.0)]
    assert names("SELECT title FROM tools WHERE fuzzy(title, 'prunnig', 2) AND fulltext(title, 'folding OR curved') LIMIT 5") == ["Folding pruning saw", "Curved pruning knife"]
    assert names("SELECT name FROM tools WHERE category = :c", c="o'reilly' OR 1=1") == []
    for bad in ("SELECT DISTINCT * FROM tools", "SELECT title FROM tools WHERE title LIKE ''", "SELECT title FROM tools WHERE category BETWEEN 'a' AND 'b'", "SELECT SUM(DISTINCT price) FROM tools", "SELECT COUNT(DISTINCT price, stock) FROM tools", "SELECT nope FROM tools", "SELECT title FROM tools WHERE price = :missing", "SELECT title, COUNT(*) FROM tools GROUP BY category"):
        with pytest.raises(ValueError):
            p.sql(bad)
    with pytest.warns(UserWarning):
        p.sql("SELECT title FROM tools WHERE title = 'the saw'")


def test_streaming_upsert_and_windows(spark, tmp_path):
    from lodestone.streaming.ingest import deduplicated, upsert_into, windowed_counts

    src = str(tmp_path / "in")
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([("bruno", 30, at), ("bruno", 30, at), ("zed", 5, at + dt.timedelta(hours=30))], "name string, years int, t timestamp").write.parquet(src)
    stream = spark.readStream.schema("name string, years int, t timestamp").parquet(src)
    index = crew(spark)
    q = upsert_into(index, deduplicated(stream, "name", "t", "1 day").drop("t"), str(tmp_path / "ck"))
    q.awaitTermination(60)
    assert index.df.count() == 9 and index.fetch("bruno").years == 30
    w = windowed_counts(stream, "t", "1 day", "2 days", ["name"]).writeStream.format("memory").queryName("w1").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "ck2")).start()
    w.awaitTermination(60)
    assert sorted((r.name, r.n) for r in spark.table("w1").collect()) == [("bruno", 2), ("zed", 1)]
    assert time.time() > 0


def test_cache_check_asks_with_every_entry(spark, tmp_path):
    from lodestone.queries.platform import cache_check

    rng = np.random.default_rng(3)
    vec = lambda: [float(x) for x in rng.normal(size=64)]
    rows = [(f"e{i:02d}", f"p{i}", "r", vec(), 1.0, 1.0) for i in range(60)]
    spark.createDataFrame(rows, "entry_id string, prompt string, response string, prompt_vector array<float>, inserted_at double, updated_at double").write.parquet(str(tmp_path / "llm_cache.parquet"))
    spark.createDataFrame([(i, vec()) for i in range(3)], "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = cache_check(spark, str(tmp_path))
    own = spark.createDataFrame(rows).selectExpr("_1 AS key", "_1 AS query_id")
    assert own.join(got.where("rank = 1 AND distance = 0"), ["key", "query_id"]).count() == 60


def test_layers_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    s = IndexSchema.from_dict({"index": {"name": "layers"}, "fields": [{"name": "n", "type": "numeric"}, {"name": "t", "type": "tag"}]})
    index = SearchIndex(s, None, "key", path)
    rows = [{"key": f"k{i}", "n": i, "t": "a"} for i in range(20)]
    assert index.load(rows) == 20 and index.create()
    assert index.load([{"key": "k1", "n": 100, "t": "b"}, {"key": "k1", "n": 101, "t": "c"}, {"key": "z", "n": 5, "t": "c"}]) == 3
    assert index.fetch("k1").n == 101 and index.df.count() == 21
    assert index.drop_keys(["k2", "k3", "none"]) == 2 and index.update_by_filter(Num("n") == 5, {"t": "five"}).processed == 2
    assert index.expire_keys("k7", 0) == 1
    sizes = {p.name: sum(f.stat().st_size for f in p.rglob("*.parquet")) for p in (tmp_path / "t").iterdir() if p.name.startswith("v-")}
    assert len(sizes) == 5  # the load and four changes, each with its own rows only
    again = SearchIndex.from_existing("layers", path=path)
    assert SearchIndex.listall(str(tmp_path)) == ["layers"] and again.schema.to_dict() == s.to_dict() and again.key == "key"
    live = {r.key: (r.n, r.t) for r in again.df.collect()}
    assert live["k1"] == (101, "c") and live["z"] == (5, "five") and live["k5"] == (5, "five") and not {"k2", "k3", "k7"} & set(live) and len(live) == 18
    for k in range(SearchIndex.MAX_LAYERS):
        index.load([{"key": "z", "n": k, "t": "c"}])
    assert index.fetch("z").n == SearchIndex.MAX_LAYERS - 1 and index.df.count() == 18
    assert index.vacuum() > 5 and SearchIndex(s, None, "key", path).df.count() == 18
    assert index.clear() == 18 and SearchIndex(s, None, "key", path).df.count() == 0
    index.delete(drop=True)
    assert not (tmp_path / "t").exists() and not index.exists()


def test_a_failed_validation_leaves_the_old_version(spark, tmp_path):
    a = IndexSchema.from_dict({"index": {"name": "t"}, "fields": [{"name": "n", "type": "numeric"}, {"name": "v", "type": "vector", "attrs": {"dims": 2}}]})
    before = spark.createDataFrame([("a", 1, [1.0, 2.0]), ("b", 2, [1.0])], "key string, n int, v array<float>")
    p = M.plan(a, a)
    assert M.validate(before, before, p).failures == []  # what could not be read before is no fault
    worse = spark.createDataFrame([("a", 1, [1.0]), ("b", 2, [1.0])], "key string, n int, v array<float>")
    assert M.validate(before, worse, p).failures == ["1 more vectors cannot be read"]
    assert M.validate(before, before.where("n = 1").drop("n"), p).failures == ["columns are missing", "the number of rows differs", "1 keys are missing"]


def test_fetch_is_pushed_and_pages_are_sought(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id AS key", "CASE WHEN id % 7 = 0 THEN NULL ELSE id % 5 END AS n").write.parquet(path)
    s = IndexSchema.from_dict({"index": {"name": "p"}, "fields": [{"name": "n", "type": "numeric"}]})
    index = SearchIndex(s, spark.read.parquet(path), "key")
    assert index.fetch("42").key == 42 and index.fetch("nothing") is None
    for up in ("ASC", "DESC"):
        got = [(r["n"], r["key"]) for page in index.paginate(S.FilterQuery(sort_by=("n", up)), 9) for r in page]
        order = (lambda x: (x[0] is not None, x[0] or 0, x[1])) if up == "ASC" else (lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        assert len(got) == 100 and got == sorted(got, key=order)


def test_schema_of_a_table(spark):
    df = spark.createDataFrame([("1", "1.0,2.0", "x", [1.0, 2.0], 1)] * 150 + [("word", "1.0,2.0", "y", [1.0], 2)], "a string, g string, t string, v array<double>, k int")
    s = IndexSchema.from_table("x", df)
    assert s.fields["v"].dims == 2 and s.fields["v"].datatype == "float64"
    assert {f["name"]: f["type"] for f in s.generate_fields(df)} == {"a": "text", "g": "geo", "t": "text", "v": "vector", "k": "numeric"}  # one word among numbers, in the last row


def test_router_and_caches_are_kept(spark, tmp_path):
    table = {"hello": [1.0, 0.0], "bye": [0.0, 1.0]}
    r = R.SemanticRouter("r", [R.Route("greeting", ["hello"], distance_threshold=0.3), R.Route("farewell", ["bye"], distance_threshold=0.2)], table.__getitem__, spark=spark)
    r.save(str(tmp_path / "router"))

    def never(_):
        raise AssertionError("embedded again")

    assert R.SemanticRouter.from_existing(str(tmp_path / "router"), never, spark)(vector=[1.0, 0.1]).name == "greeting"
    cache = C.EmbeddingsCache(spark.createDataFrame([], C.EmbeddingsCache.SCHEMA), ttl=100)
    cache.mset(spark.createDataFrame([("a", "m", [1.0], None), ("b", "m", [2.0], None)], "content string, model_name string, embedding array<float>, metadata string"))
    a, b = C.embedding_key("a", "m"), C.embedding_key("b", "m")
    before = cache.index._raw().selectExpr("max(_expires_at)").first()[0]
    time.sleep(0.05)
    assert [x and x["content"] for x in cache.mget_by_keys([b, "none", a, b])] == ["b", None, "a", "b"] and cache.mexists_by_keys(["none", a]) == [False, True]
    assert cache.index._raw().selectExpr("min(_expires_at)").first()[0] > before
    assert cache.mdrop_by_keys([a]) == 1 and cache.mexists_by_keys([a, b]) == [False, True]


def test_stored_llm_is_assistant(spark):
    h = H.MessageHistory(session="s", spark=spark)
    h.add_message({"role": "llm", "content": "old"}, now=1.0)
    h.add_message({"role": "assistant", "content": "new"}, now=2.0)
    assert H.as_context(h.get_recent(5, role="assistant"), as_text=True) == ["old", "new"] == H.as_context(h.get_recent(5, role=["llm"]), as_text=True)
