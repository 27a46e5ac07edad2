import numpy as np

from lodestone.operators.ann import CellIndex, recall
from lodestone.operators.search import BATCH_QUERIES, batch_knn


def test_recall_pruning_and_bad_vectors(spark, tmp_path):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(20, 16))
    x = centres[rng.integers(20, size=1500)] + 0.5 * rng.normal(size=(1500, 16))
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(x)] + [(9001, None), (9002, [0.0] * 16), (9003, [1.0])]
    df = spark.createDataFrame(rows, "k long, v array<float>")
    index = CellIndex.build(df, "k", "v", 16, path=str(tmp_path / "ivf"))
    assert index.table.count() == 1500
    queries = df.where("k % 50 = 0")
    exact = batch_knn(df, "k", "v", queries, "k", "v", 16, 10)
    assert recall(index.search(queries, "k", "v", 10, probes=8), exact) >= 0.9
    assert recall(index.search(queries, "k", "v", 10, probes=10_000), exact) == 1.0
    plan = index.search(queries.limit(1), "k", "v", 10, probes=2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [cell" in plan
    assert CellIndex.build(df.limit(0), "k", "v", 16).search(queries, "k", "v").count() == 0


def test_more_queries_than_one_round(spark):
    rng = np.random.default_rng(11)
    df = spark.createDataFrame([(f"k{k}", [float(c) for c in v]) for k, v in enumerate(rng.integers(-2, 3, size=(BATCH_QUERIES + 300, 4)))], "k string, v array<float>")
    index = CellIndex.build(df.where("substring(k, -1) = '7'"), "k", "v", 4, cells=30)
    exact = batch_knn(df.where("substring(k, -1) = '7'"), "k", "v", df, "k", "v", 4, 10)  # whole numbers: many equal distances
    near = index.search(df, "k", "v", 10, probes=30)
    assert near.select("query_id", "rank", "key").exceptAll(exact.select("query_id", "rank", "key")).count() == 0
    assert near.count() == exact.count() > 10 * BATCH_QUERIES
    assert recall(index.search(df, "k", "v", 10, probes=15), exact) >= 0.8
    assert recall(near.where("rank <= 5"), exact) == 0.5


def test_vector_queries_use_a_built_index(spark):
    from lodestone.operators import search as S
    from lodestone.operators.filters import Num
    from lodestone.operators.index import SearchIndex
    from lodestone.schema import IndexSchema

    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 16))
    rows = [(k, [float(c) for c in centres[k % 20] + 0.2 * rng.normal(size=16)], k % 3) for k in range(2000)]
    df = spark.createDataFrame(rows, "k long, v array<float>, n int")
    schema = IndexSchema.from_dict({"index": {"name": "a"}, "fields": [{"name": "n", "type": "numeric"}, {"name": "v", "type": "vector", "attrs": {"dims": 16, "algorithm": "hnsw"}}]})
    index = SearchIndex(schema, df, "k")
    q = S.VectorQuery(vector=rows[7][1], field_name="v", filter=Num("n") == 1, num_results=10)
    exact = [r.k for r in index.query(q).collect()]
    cells = index.build_ann("v")
    near = index.query(q)
    assert [r.k for r in near.collect()] == exact and "PartitionFilters: [cell" in near._jdf.queryExecution().executedPlan().toString()
    assert cells.probes(1) < cells.probes(20) <= cells.probes(10**9) == len(cells.centres)
    index.drop_keys([str(exact[0])])
    assert [r.k for r in index.query(q).collect()][0] == exact[1]  # a write puts the exact scan back
