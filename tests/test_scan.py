import numpy as np
import pandas as pd
import pytest

from lodestone.plans.physical import OrderedScan, bounded_broadcast, stage_table


@pytest.mark.parametrize("horizon", [None, 3.0])
def test_positions_states_and_context_cross_partitions(spark, horizon):
    rng = np.random.default_rng(1)
    rows = [("hot" if rng.random() < 0.6 else f"g{rng.integers(5)}", float(k)) for k in range(2000)]
    df = spark.createDataFrame(rows, "g string, t double").repartition(7)
    scan = OrderedScan(df, "g", ["t"], horizon)
    if horizon:
        scan.looking_back("t", horizon)

    def mark(both: pd.DataFrame, n: int, position: np.ndarray, state: float | None):
        own, near, sums = both.iloc[n:], [], []
        for g, t in zip(own["g"], own["t"]):
            near.append(int(((both["g"] == g) & (both["t"] < t) & (both["t"] >= t - (horizon or 0))).sum()))
        state, name = state or 0.0, own["g"].iloc[0]
        for g, t in zip(own["g"], own["t"]):
            state, name = (state if g == name else 0.0) + t, g
            sums.append(state)
        return own.assign(near=near, total=sums, position=position), state

    fold = lambda state, part: (state or 0.0) + part["t"].sum()
    got = scan.map(mark, "g string, t double, near int, total double, position long", fold, lambda a, b: a + b).toPandas()
    want = pd.DataFrame(rows, columns=["g", "t"]).sort_values(["g", "t"])
    want["near"] = [int(((want.g == g) & (want.t < t) & (want.t >= t - (horizon or 0))).sum()) for g, t in zip(want.g, want.t)]
    want["total"] = want.groupby("g").t.cumsum()
    want["position"] = want.groupby("g").cumcount() + 1
    pd.testing.assert_frame_equal(got.sort_values(["g", "t"]).reset_index(drop=True), want.reset_index(drop=True), check_dtype=False)
    assert scan.rows.rdd.getNumPartitions() > 1
    assert OrderedScan(df.limit(0), "g", ["t"]).map(mark, "g string, t double, near int, total double, position long", fold, lambda a, b: a + b).count() == 0


def test_helpers(spark):
    df = spark.range(10)
    assert stage_table(df).count() == 10 and stage_table(df.limit(0)).count() == 0
    assert "ResolvedHint" not in bounded_broadcast(df, 5)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in bounded_broadcast(df, 50)._jdf.queryExecution().analyzed().toString()
