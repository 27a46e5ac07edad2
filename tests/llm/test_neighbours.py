import numpy as np

from lodestone.llm import neighbours

SCHEMA = "key string, vec array<float>, vid int"


def brute(rows, k, limit, dims):
    got = {}
    for key, v in rows:
        if key is not None and v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v) and any(v):
            got[key] = np.array(v, "float32").astype("float64")
    keys = sorted(got)
    x = np.stack([got[c] for c in keys])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = np.maximum(1 - x @ x.T, 0).round(9)
    top = []
    for i in range(len(keys)):
        order = sorted((d[i, j], keys[j], j) for j in range(len(keys)) if j != i)
        top.append({j for dist, _, j in order[:k] if dist <= limit})
    return {(keys[i], keys[j]) for i in range(len(keys)) for j in top[i] if i < j and i in top[j]}


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 16))
    dense = rng.normal(size=16) + 0.15 * rng.normal(size=(150, 16))
    close = base[:200] + 0.05 * rng.normal(size=(200, 16))
    vecs = np.concatenate([base, dense, close]).astype("float32")
    rows = [(f"k{i:04d}", [float(x) for x in v]) for i, v in enumerate(vecs)]
    rows += [(f"c{i:02d}", rows[0][1]) for i in range(30)] + [rows[7]] * 5
    rows += [("n1", None), ("n2", []), ("n3", [0.0] * 16), ("n4", [float("nan")] * 16), ("n5", [1.0] * 15), ("n6", [None] + [1.0] * 15), (None, rows[1][1]), ("n7", [float("inf")] + [1.0] * 15), ("n8", [0.0] * 16)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {(r.key_a, r.key_b) for r in neighbours.mutual(df, "key", "vec", dims=16, tables=6).collect()}
    want = brute(rows, 10, 0.09, 16)
    assert len(got & want) >= 0.98 * len(want)
    assert len(got - want) <= 0.02 * len(want)
    assert neighbours.mutual(df.limit(0), "key", "vec", dims=16).count() == 0


def test_heavy_buckets_are_split(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HEAVY_ROWS", 8)
    rng = np.random.default_rng(6)
    centre = rng.normal(size=16)
    x = centre + 0.3 * rng.normal(size=(300, 16))
    rows = [(f"k{i:04d}", [float(c) for c in v.astype("float32")]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = {(r.key_a, r.key_b) for r in neighbours.mutual(df, "key", "vec", dims=16, tables=8).collect()}
    want = brute(rows, 10, 0.09, 16)
    assert len(got & want) >= 0.9 * len(want)


def test_a_dense_cluster_gives_no_more_than_k_candidates_a_vector(spark, monkeypatch):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=16)
    x = np.concatenate([centre + 0.1 * rng.normal(size=(1500, 16)), rng.normal(size=(500, 16))])
    rows = [(f"k{i:04d}", [float(c) for c in v.astype("float32")]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    want = brute(rows, 10, 0.09, 16)
    for heavy in (100_000, 200):  # the cluster in one bucket; and split by further levels
        monkeypatch.setattr(neighbours, "HEAVY_ROWS", heavy)
        got = {(r.key_a, r.key_b) for r in neighbours.mutual(df, "key", "vec", dims=16, tables=8).collect()}
        assert len(got & want) >= (0.98 if heavy > 1000 else 0.9) * len(want) and len(got - want) <= 0.1 * len(want)
    monkeypatch.setattr(neighbours, "HEAVY_ROWS", 100_000)
    vectors = df.selectExpr("xxhash64(vec) AS vid", "vec")
    assert neighbours.candidates(vectors, 2000, 16, 0.09, 10, 4).count() < 4 * 11 * 3 * 2000


def test_rotation_keeps_lengths_and_levels_follow_size():
    r = neighbours.rotation(64, 3)
    assert np.allclose(r @ r.T, np.eye(64), atol=1e-5)
    assert neighbours.levels(10, 64) == [1] and neighbours.levels(10**6, 64)[0] == 64 and len(neighbours.levels(10**9, 64)) > 2


def exact(rows, k, dims):
    """The k nearest other keys of each key and their distances; of a key with several vectors the nearest counts."""
    good = {(key, tuple(np.array(v, "float32").astype("float64"))) for key, v in rows if key is not None and v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    keys, x = [g[0] for g in sorted(good)], np.array([g[1] for g in sorted(good)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    d = np.maximum(1 - x @ x.T, 0).round(9)
    out = {}
    for key in set(keys):
        best = {}
        for i in np.flatnonzero(np.array(keys) == key):
            for j, other in enumerate(keys):
                if other != key:
                    best[other] = min(best.get(other, 9.0), d[i, j])
        out[key] = sorted((dist, other) for other, dist in best.items())[:k]
    return out


def lists(df):
    got = {}
    for r in df.orderBy("key", "nth").collect():
        got.setdefault(r.key, []).append((round(r.distance, 9), r.neighbour))
        assert r.nth == len(got[r.key])
    return got


def test_nearest_lists_ten_at_any_distance(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    monkeypatch.setattr(neighbours, "TASK_BLOCKS", 2)
    monkeypatch.setattr(neighbours, "TILE", (16, 32))
    rng = np.random.default_rng(8)
    rows = [(f"k{i:03d}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(400, 16)).astype("float32"))]
    rows += [(f"c{i}", rows[0][1]) for i in range(4)] + [(f"s{i}", [x * 2.0**i for x in rows[1][1]]) for i in range(1, 14)] + [rows[7]] * 3
    rows += [("n1", None), ("n2", [0.0] * 16), ("n3", [float("nan")] * 16), ("n4", [1.0] * 15), ("n5", [None] + [1.0] * 15), (None, rows[1][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert lists(neighbours.nearest(df, "key", "vec", dims=16, exact=True)) == exact(rows, 10, 16)
    assert neighbours.nearest(df.limit(0), "key", "vec", dims=16).count() == 0
    assert neighbours.nearest(df.where("key = 'k005'"), "key", "vec", dims=16).count() == 0


def test_nearest_of_keys_with_several_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(f"k{i % 40:02d}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(100, 16)).astype("float32"))]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert lists(neighbours.nearest(df, "key", "vec", dims=16, exact=True)) == exact(rows, 10, 16)


def test_every_copy_has_its_list(spark):
    rng = np.random.default_rng(10)
    rows = [(f"k{i:03d}", [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(60, 16)).astype("float32"))]
    rows += [(f"c{i:02d}", rows[0][1]) for i in range(30)] * 2
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    got = lists(neighbours.nearest(df, "key", "vec", dims=16, exact=True))
    assert got == exact(rows, 10, 16) and len(got["c29"]) == 10
    rows += [("c29", rows[5][1]), ("c28", rows[6][1])] + [(f"a{i:02d}", rows[6][1]) for i in range(12)]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    assert lists(neighbours.nearest(df, "key", "vec", dims=16, exact=True)) == exact(rows, 10, 16)


def test_hashed_lists_hold_most_of_the_true_ones(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "WIDE_ROWS", 100)
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(12, 16))
    x = np.concatenate([centres[rng.integers(12, size=1200)] + 0.5 * rng.normal(size=(1200, 16)), centres[0] + 0.05 * rng.normal(size=(700, 16))]).astype("float32")
    rows = [(f"k{i:04d}", [float(c) for c in v]) for i, v in enumerate(x)] + [("c1", [float(c) for c in x[0]])] * 2
    rows += [("n1", None), ("n2", [0.0] * 16), ("n3", [float("nan")] * 16), (None, rows[1][1])]
    df = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    true = exact(rows, 10, 16)
    for most in (4096, 40):  # 40: nearly every bucket is split further
        monkeypatch.setattr(neighbours, "HEAVY_ROWS", most)
        got = {}
        for r in neighbours.nearest(df, "key", "vec", dims=16, tables=10).orderBy("key", "nth").collect():
            got.setdefault(r.key, []).append((r.distance, r.neighbour))
        found = sum(len({n for _, n in got.get(k, [])} & {n for _, n in w}) for k, w in true.items())
        assert found >= (0.9 if most > 1000 else 0.6) * sum(map(len, true.values()))
        assert got["c1"][0] == (0.0, "k0000") and all(a == sorted(a) and len({n for _, n in a}) == len(a) for a in got.values())
        near = {(k, n): d for k, w in true.items() for d, n in w}
        assert all(abs(d - near[k, n]) < 1e-4 for k, w in got.items() for d, n in w if (k, n) in near)
    assert neighbours.nearest(df.limit(0), "key", "vec", dims=16).count() == 0
    assert neighbours.recall(df, "key", "vec", 16).first().recall >= 0.8
