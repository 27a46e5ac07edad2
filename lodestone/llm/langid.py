"""Language of words and segments: a hashed character n-gram naive Bayes model, fitted by ``train_langid``.

Latin-script words are scored by their character n-grams; kana, han and Cyrillic decide by script and letters. The last
language, ``other``, is what the model does not know: it gathers scripts and letters that none of its languages has.
Word scores are kept in a bounded table for each worker, since words repeat far more often than texts.
"""

from __future__ import annotations

import os
import re
import zlib
from functools import lru_cache

import numpy as np

#: The languages of the model, in the order of its columns (fixed values).
LANGS = ["en", "de", "fr", "es", "pt", "it", "nl", "ru", "ja", "other"]
LATIN = LANGS[:7]
DIMS = 1 << 13
MODEL = os.path.join(os.path.dirname(__file__), "models", "langid.npz")

WORD = re.compile(r"[^\W\d_]+")
KANA = re.compile(r"[぀-ヿ㐀-䶿一-鿿]")
HAN = re.compile(r"[㐀-䶿一-鿿]")
CYRILLIC = re.compile(r"[Ѐ-ӿ]")
#: Cyrillic letters that Russian does not have, and Latin ones that none of the seven languages has (fixed values).
NOT_RUSSIAN = re.compile(r"[іїєґўђћљњџјѓќѕәғқңөұүһ]")
NOT_LATIN7 = re.compile(r"[ąćęłńśźżőűşğıåøčďěňřšťůžđțșăľĺŕāēģīķļņūėųįþðĩũơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ]")
LATIN_LETTER = re.compile(r"[a-zà-ɏḀ-ỿ]")


def grams(word: str) -> list[int]:
    """Hashed n-grams of a lower-case word with its edges: the word itself and its runs of 2 to 4 characters."""
    w = f"<{word}>"
    out = [zlib.crc32(w.encode()) % DIMS]
    for n in (2, 3, 4):
        out += [zlib.crc32(w[i : i + n].encode()) % DIMS for i in range(len(w) - n + 1)]
    return out


@lru_cache(maxsize=1)
def weights() -> np.ndarray:
    return np.load(MODEL)["w"].astype("float32")


class WordScores:
    """Log-likelihood of each language for a word; the table is emptied when it holds ``keep`` words."""

    def __init__(self, keep: int = 200_000) -> None:
        self.w, self.keep = weights(), keep
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, len(LANGS)), "float32")

    def score(self, word: str) -> np.ndarray:
        out = np.zeros(len(LANGS), "float32")
        low = word.lower()
        if KANA.search(low):
            # half of the characters of Japanese are kana, none of Chinese
            out[8], out[9] = 3.0 * len(low), 3.3 * len(HAN.findall(low))
        elif CYRILLIC.search(low):
            out[7], out[9] = (2.0, 10.0) if NOT_RUSSIAN.search(low) else (6.0, 4.0)
        elif not LATIN_LETTER.search(low):
            out[9] = 6.0
        elif len(low) > 1 or low in "aeiouyàéèó":
            g = self.w[grams(low)].mean(axis=0) * min(6, 2 + len(low) ** 0.5)
            g = np.maximum(g - g.max(), -6)
            out[:7] = g - g.mean()
            if NOT_LATIN7.search(low):
                out[9] = out[:7].max() + 3.0
        return out

    def add(self, words: set[str]) -> None:
        if len(self.index) + len(words) > self.keep:
            self.index = {}
        for word in words:
            if word not in self.index:
                i = self.index[word] = len(self.index)
                if i >= len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[i] = self.score(word)


@lru_cache(maxsize=1)
def scores() -> WordScores:
    return WordScores()


def text_scores(texts: list[str], block: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Summed scores (texts x languages) and the number of words of each text; whole texts, in blocks."""
    s = scores()
    out = np.zeros((len(texts), len(LANGS)), "float32")
    n = np.zeros(len(texts), "int64")
    for at in range(0, len(texts), block):
        words = [WORD.findall(t) for t in texts[at : at + block]]
        flat = [w for ws in words for w in ws]
        if not flat:
            continue
        try:
            ids = np.fromiter(map(s.index.__getitem__, flat), "int64", len(flat))
        except KeyError:
            s.add(set(flat))
            ids = np.fromiter(map(s.index.__getitem__, flat), "int64", len(flat))
        sizes = np.fromiter(map(len, words), "int64", len(words))
        full = np.flatnonzero(sizes)
        starts = (np.cumsum(sizes) - sizes)[full]
        out[at + full] = np.add.reduceat(s.table[ids], starts, axis=0)
        n[at : at + len(words)] = sizes
    return out, n
