import math
import warnings

import numpy as np
import pytest

from lodestone.operators import search as S
from lodestone.operators.filters import Tag
from tests.fixtures import CREW, crew

V = [0.9, 0.2, 0.1]


def cos(a, b):
    a, b = np.array(a, "float32").astype(float), np.array(b, "float32").astype(float)
    return 1 - a @ b / math.sqrt((a @ a) * (b @ b))


def test_knn_and_range(spark):
    index = crew(spark)
    rows = index.query(S.VectorQuery(vector=V, field_name="skills", num_results=8)).collect()
    assert [r.name for r in rows][:2] == ["ada", "chidi"]
    for r in rows:
        assert abs(r.vector_distance - cos(V, r.skills)) < 1e-6
    for k in range(1, 8):
        assert [r.name for r in index.query(S.VectorQuery(vector=V, field_name="skills", num_results=k)).collect()] == [r.name for r in rows[:k]]
    assert index.query(S.VectorRangeQuery(vector=V, field_name="skills", distance_threshold=0.6)).count() == 4
    assert index.query(S.VectorRangeQuery(vector=V, field_name="skills", distance_threshold=0.54)).count() == 3
    assert index.query(S.VectorRangeQuery(vector=V, field_name="skills", distance_threshold=0.7, filter=Tag("grade") == "senior", num_results=2)).count() == 2
    near = index.query(S.VectorQuery(vector=V, field_name="skills", num_results=3, sort_by=("years", "DESC"))).collect()
    assert {r.name for r in near} == {r.name for r in rows[:3]} and [r.years for r in near] == sorted((r.years for r in near), reverse=True)
    normal = index.query(S.VectorQuery(vector=V, field_name="skills", normalize=True)).collect()
    assert all(0 <= r.vector_distance <= 1 for r in normal)


def test_plan_is_a_top_k(spark):
    df = crew(spark).query(S.VectorQuery(vector=V, field_name="skills", return_fields=["years"]))
    assert "TakeOrderedAndProject" in df._jdf.queryExecution().executedPlan().toString()
    assert df.columns == ["name", "years", "vector_distance"]


def test_validation(spark):
    index = crew(spark)
    with pytest.raises(ValueError):
        index.query(S.VectorQuery(vector=[1.0], field_name="skills"))
    for bad in ({"ef_runtime": 5}, {"hybrid_policy": "X"}, {"batch_size": 0}, {"use_search_history": "MAYBE"}, {"epsilon": -1}, {"search_window_size": True}):
        with pytest.raises(ValueError):
            index.query(S.VectorQuery(vector=V, field_name="skills", options=S.ApproximateOptions(**bad)))
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        index.query(S.FilterQuery(sort_by=["years", ("name", "DESC")]))
        assert any("first sort key" in str(x.message) for x in w)
    with pytest.raises(ValueError):
        S.sort_keys(("years", "UP"))


def test_text(spark):
    index = crew(spark)
    rows = index.query(S.TextQuery(text="charts for climbing old masts", fields="note", scorer="BM25STD")).collect()
    assert {r.name for r in rows} == {"bruno", "dora", "emre", "gil"}  # bruno and gil through stems
    assert [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)
    for scorer in ("BM25STD", "BM25STD.NORM", "BM25STD.TANH", "TFIDF", "TFIDF.DOCNORM", "DISMAX", "DOCSCORE"):
        assert index.query(S.TextQuery(text="hulls ropes", fields="note", scorer=scorer)).count() == 4
    heavy = index.query(S.TextQuery(text="hulls ropes", fields="note", text_weights={"hulls": 10})).collect()
    plain = index.query(S.TextQuery(text="hulls ropes", fields="note")).collect()
    assert heavy[0].score > plain[0].score
    both = index.query(S.TextQuery(text="navigator", fields={"trade": 2.0, "note": 1.0})).collect()
    assert {r.name for r in both} == {"dora", "gil"}
    with pytest.raises(ValueError):
        index.query(S.TextQuery(text="x", fields={"trade": 0}))
    with pytest.raises(ValueError):
        index.query(S.TextQuery(text="x", fields="trade", text_weights={"two words": 1}))
    with pytest.raises(TypeError):
        index.query(S.TextQuery(text="x", fields="trade", stopwords=5))
    with pytest.raises(ValueError):
        index.query(S.TextQuery(text="x", fields="trade", scorer="HAMMING"))


def test_hybrids(spark):
    index = crew(spark)
    agg = index.query(S.AggregateHybridQuery(text="worn ropes", fields="note", vector=V, vector_field="skills", alpha=0.5)).collect()
    assert len(agg) == 8
    for r in agg:
        assert abs(r.hybrid_score - (0.5 * r.text_score + 0.5 * r.vector_similarity)) < 1e-9
        assert abs(r.vector_similarity - (2 - r.vector_distance) / 2) < 1e-9
    rrf = {r.name: r.hybrid_score for r in index.query(S.HybridQuery(text="worn ropes", fields="note", vector=V, vector_field="skills")).collect()}
    assert len(rrf) == 8 and max(rrf.values()) <= 2 / 61 + 1e-12
    lin = index.query(S.HybridQuery(text="worn ropes", fields="note", vector=V, vector_field="skills", combination="LINEAR", alpha=0.3)).collect()
    for r in lin:
        assert abs(r.hybrid_score - (0.3 * (r.text_score or 0) + 0.7 * (r.vector_similarity or 0))) < 1e-9
    with pytest.raises(ValueError):
        index.query(S.HybridQuery(text="with the in", fields="note", vector=V, vector_field="skills"))


def test_multi_vector(spark):
    index = crew(spark)
    q = S.MultiVectorQuery(vectors=[S.VectorSpec(V, "skills", 0.2), S.VectorSpec([1.0, 0.0], "photo", -1.7, 0.9)])
    for r in index.query(q).collect():
        a, b = 1 - cos(V, r.skills) / 2, 1 - cos([1.0, 0.0], r.photo) / 2
        assert abs(r.combined_score - (0.2 * a - 1.7 * b)) < 1e-4
    with pytest.raises(ValueError):
        S.VectorSpec(V, "skills", 1.0, 2.5)


def test_batch_knn_ties_and_bad_vectors(spark):
    rows = [(k, [1.0, 0.0]) for k in range(30)] + [(40, None), (41, [0.0, 0.0]), (42, [1.0]), (43, [float("nan"), 1.0]), (44, [0.0, 1.0]), (45, [None, 1.0])]
    c = spark.createDataFrame(rows, "key int, v array<float>").repartition(5)
    q = spark.createDataFrame([(1, [2.0, 0.0]), (2, None), (3, [0.0, 3.0])], "query_id int, v array<float>")
    got = S.batch_knn(c, "key", "v", q, "query_id", "v", 2, 4).collect()
    assert sorted((r["query_id"], r["key"]) for r in got if r["query_id"] == 1) == [(1, k) for k in range(4)]
    assert [r["key"] for r in got if r["query_id"] == 3 and r["rank"] == 1] == [44]
    assert S.batch_knn(c.limit(0), "key", "v", q, "query_id", "v", 2, 4).count() == 0
    assert S.batch_knn(c, "key", "v", q.limit(0), "query_id", "v", 2, 4).count() == 0


def test_index_results_and_pages(spark):
    index = crew(spark)
    assert [r.name for p in index.paginate(S.FilterQuery(sort_by="years"), 3) for r in p] == [u[0] for u in sorted(CREW, key=lambda u: u[1])]
    assert [len(p) for p in index.paginate(S.FilterQuery(), 3)] == [3, 3, 2]
    with pytest.raises(ValueError):
        next(index.paginate(S.FilterQuery(), 0))
    assert [x if isinstance(x, int) else x.count() for x in index.batch_query([S.CountQuery(), S.FilterQuery(num_results=2)])] == [8, 2]
