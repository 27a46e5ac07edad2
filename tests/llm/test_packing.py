import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import packing, tokens


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 80), max_size=120))
def test_every_item_once_and_within(sizes):
    got = packing.pack(np.array(sizes, dtype="int64"), [10, 40, 80])
    seen = sorted(i for b in got.values() for items in b.items for i in items)
    assert seen == list(range(len(sizes)))
    for capacity, b in got.items():
        for items, load in zip(b.items, b.load):
            assert sum(sizes[i] for i in items) == load <= capacity
    for capacity, b in got.items():  # best fit leaves at most one container half empty, unless it holds a longer tier's item
        if capacity == 10:
            assert sum(load * 2 <= capacity for load in b.load) <= 1


def test_gaps_of_long_windows_are_filled():
    got = packing.pack(np.array([70, 10, 9, 35]), [10, 40, 80])
    assert got[80].load == [80] and got[40].load == [35 + 0] and got[10].load == [9]


@pytest.mark.skipif(not os.path.exists(tokens.vocabulary_path()), reason="no vocabulary files")
def test_packed(spark):
    docs = [(k, "the router counts rows " * (k % 13 + 1), 1) for k in range(120)] + [(200, None, 1), (201, "", 1), (202, "row " * 300, 1), (5, "the router counts rows " * 6, 1), (None, "x", 1)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, container int")
    limits = spark.createDataFrame([("documents.a", 20), ("documents.b", 64), ("documents.c", 128), ("chat_messages.user", 5)], "scope string, max_size int")
    sizes = {(r.doc_id): len(r.ids) for r in tokens.encode(docs).collect()}
    for each in (False, True):
        rows = packing.packed(docs, limits, each=each).collect()
        loads, per = {}, {}
        for r in rows:
            loads[r.container, r.capacity] = loads.get((r.container, r.capacity), 0) + r.n_tokens
            per.setdefault((r.doc_id, r.capacity if each else 0), []).append(r)
        assert all(v <= c for (_, c), v in loads.items())
        for (doc, _), rs in per.items():
            copies = 2 if doc == 5 else 1
            assert sum(r.n_tokens for r in rs) == copies * sizes[doc]
            assert each or len(rs) == copies * max(1, -(-sizes[doc] // 128))
        assert len({k[0] for k in per}) == 124
    got = packing.fill(packing.packed(docs, limits)).collect()
    room = sum(r.containers * r.capacity for r in got)
    assert 1 - sum(r.tokens for r in got) / room < 0.1
    assert packing.packed(docs.limit(0), limits).count() == 0
    with pytest.raises(ValueError):
        packing.packed(docs, limits.limit(0))


def test_step_groups_of_several_shards_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_ROWS", 50)
    docs = spark.createDataFrame([(i, "some plain words of text " * (1 + i % 5)) for i in range(400)], "doc_id long, text string")
    limits = spark.createDataFrame([("documents.a", 20), ("documents.b", 40)], "scope string, max_size int")
    rows = packing.packed(docs, limits, step=4).collect()
    shards, groups = set(), {}
    for r in rows:
        shards.add(r.container.split("-")[1])
        groups.setdefault((r.capacity, r.step_group), set()).add(r.container)
    assert len(shards) > 1 and max(len(g) for g in groups.values()) <= 4
    assert all(len({c.split("-")[1] for c in g}) == 1 for g in groups.values())
