import base64
import os
import random

import pytest

from lodestone.llm import tokens

PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.vocabulary_path()), reason="no vocabulary files")


def reference(texts):
    import tiktoken

    with open(tokens.vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [enc.encode_ordinary(t or "") for t in texts]


def test_ids_and_round_trip(spark):
    random.seed(2)
    texts = ["", None, " ", "it's  two\n\n words ", "a b　c   d\x1fe\x85f", "ñandú été 日本語。 ١٢٣ ½ ² 🙂🙂 é", "<|endoftext|> x", "\r\n\t  x  \r\n", "x" * 5000, "I'LL we'll 'S 'ſ"]
    texts += ["".join(random.choices(" \n\tab1'é日.-​ ", k=60)) for _ in range(40)] + [("The router counts rows. " * 3000)]
    rows = [(k, t, 1, "z") for k, t in enumerate(texts)] + [(3, texts[3], 1, "z"), (3, "other", 1, "z"), (None, "null key", 1, "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pos int, word string")
    got = tokens.encode(df)
    want = sorted((r[0] if r[0] is not None else -1, tuple(i)) for r, i in zip(rows, reference([r[1] for r in rows])))
    assert sorted((r.doc_id if r.doc_id is not None else -1, tuple(r.ids)) for r in got.collect()) == want
    back = tokens.decode(got)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in back.collect()) == sorted((r[0] if r[0] is not None else -1, r[1] or "") for r in rows)
    assert tokens.encode(df.limit(0)).count() == 0


def test_shuffle_path_is_the_same(spark, monkeypatch):
    df = spark.createDataFrame([(k, "the the router %d" % (k % 3)) for k in range(30)], "doc_id long, text string")
    want = sorted(map(str, tokens.encode(df).collect()))
    monkeypatch.setattr(tokens, "BROADCAST_WORDS", 1)
    assert sorted(map(str, tokens.encode(df).collect())) == want
