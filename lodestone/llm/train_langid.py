"""Fits models/langid.npz on labelled documents: ``python -m lodestone.llm.train_langid DIR``.

Labels are dirty, so the fit is repeated: after each round only segments whose label agrees with the
model's own decision are kept.
"""

from __future__ import annotations

import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from lodestone.llm import langid

#: At most this many labelled rows are read.
SAMPLE_ROWS = 20_000


def fit(words: dict[str, Counter]) -> np.ndarray:
    counts = np.full((langid.DIMS, 7), 0.05)
    for k, lang in enumerate(langid.LATIN):
        for w, c in words[lang].items():
            np.add.at(counts[:, k], langid.grams(w), c**0.5)
    logp = np.log(counts / counts.sum(axis=0))
    return logp - logp.mean(axis=1, keepdims=True)


def main(root: str) -> None:
    d = pd.read_parquet(f"{root}/documents.parquet", columns=["text", "lang"]).dropna().head(SAMPLE_ROWS)
    label = d.lang.str.strip().str.lower().str[:2].where(lambda s: s.isin(langid.LATIN))
    d = d.assign(label=label).dropna()
    segments = []
    for t, y in zip(d.text, d.label):
        for s in re.split(r"(?<=[.!?])\s+|\n+", re.sub(r"```.*?```", " ", t, flags=re.S)):
            ws = [w.lower() for w in langid.WORD.findall(s)]
            if len(ws) >= 4:
                segments.append((y, tuple(ws)))
    segments = list(dict.fromkeys(segments))
    w = None
    for _ in range(3):
        words: dict[str, Counter] = defaultdict(Counter)
        kept = 0
        for y, ws in segments:
            if w is None or langid.LATIN[int(np.argmax(w[[g for x in ws for g in langid.grams(x)]].sum(axis=0)))] == y:
                words[y].update(ws)
                kept += 1
        w = fit(words)
        print(f"{kept} of {len(segments)} segments kept")
    np.savez_compressed(langid.MODEL, w=w.astype("float16"))


if __name__ == "__main__":
    main(sys.argv[1])
