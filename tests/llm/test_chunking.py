import random

from hypothesis import given, settings
from hypothesis import strategies as st

from lodestone.llm import chunking

LIMIT_SCHEMA = "scope string, unit string, max_size int, overlap_size int"
LIMITS = [("chat_messages.user", "characters", 50, 10), ("chat_messages.other", "characters", 30, 0), ("documents.small", "tokens", 5, 0)]


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .,\n!é日", max_size=400), st.integers(1, 60), st.integers(0, 60))
def test_split_tiles_and_fits(text, size, overlap):
    spans = chunking.split(text, size, overlap)
    assert "".join(text[a:b] for a, b in spans) == text
    shared = min(overlap, size - 1)
    for k, (a, b) in enumerate(spans):
        assert a < b and (k == 0 or a >= shared)
        assert b - a + (shared if k else 0) <= size


def test_merges_until_nothing_fits():
    random.seed(1)
    text = " ".join("word" * random.randint(1, 4) + random.choice(["", ".", ","]) for _ in range(300))
    spans = chunking.split(text, 120, 20)
    assert all(b2 - a1 > 100 for (a1, _), (_, b2) in zip(spans, spans[1:]))


def test_prefers_strong_boundaries():
    text = "First part is here. " * 3 + "\n\n" + "Second part is there. " * 3
    assert [text[a:b].strip()[:5] for a, b in chunking.split(text, 75, 0)] == ["First", "Secon"]


def test_any_overlap_below_the_limit_is_kept_and_a_null_one_is_none(spark):
    chat = spark.createDataFrame([("a", "user", "one two three four five six seven"), ("b", "tool", "y" * 25)], "entry_id string, role string, content string").selectExpr("*", "timestamp_seconds(1) ingested_at")
    limits = spark.createDataFrame([("chat_messages.user", "characters", 10, 9), ("chat_messages.tool", "characters", 10, None)], LIMIT_SCHEMA)
    got = chunking.pieces(chat, limits).orderBy("entry_id", "piece_no").collect()
    a = [r.piece for r in got if r.entry_id == "a"]
    assert all(p[-9:] == q[:9] for p, q in zip(a, a[1:])) and max(map(len, a)) == 10
    assert [len(r.piece) for r in got if r.entry_id == "b"] == [10, 10, 5]


def test_pieces_edge_cases(spark):
    limits = spark.createDataFrame(LIMITS, "scope string, unit string, max_size int, overlap_size int")
    long = "A sentence here. " * 8
    rows = [
        ("a", " Human", long, 1, "x"), ("a", "user", long, 2, "y"), ("b", None, "short", 1, "x"), ("c", "??", "é" * 31, 1, "x"),
        ("d", "user", None, 1, "x"), ("e", "user", "", 1, "x"), (None, "user", long, 1, "x"), ("f", "user", "x" * 50, 1, "x"), ("g", "tool", "y" * 999, 1, "x"),
    ]
    schema = "entry_id string, role string, content string, at int, piece string"
    chat = spark.createDataFrame(rows, schema).selectExpr("*", "timestamp_seconds(at) ingested_at")
    got = chunking.pieces(chat, limits).orderBy("entry_id", "piece_no").collect()
    assert {r.entry_id for r in got} == {"a", "c"}
    a = [r for r in got if r.entry_id == "a"]
    assert "".join(r.piece[r.overlap_chars :] for r in a) == long
    assert all(len(r.piece) == r.n_chars <= 50 for r in a)
    assert all(p.piece[-10:] == q.piece[:10] for p, q in zip(a, a[1:]))
    assert sorted(r.entry_id for r in chunking.found(chat, limits).collect()) == ["a", "c"]
    assert chunking.pieces(chat.limit(0), limits).count() == 0
