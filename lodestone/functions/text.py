"""Tokens, stems and relevance scores."""

from __future__ import annotations

import math
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPLIT = r"[^\p{L}\p{N}_]+"
K1, B = 1.2, 0.75
SCORERS = ("BM25STD", "BM25", "BM25STD.NORM", "BM25STD.TANH", "TFIDF", "TFIDF.DOCNORM", "DISMAX", "DOCSCORE", "HAMMING")


def raw_tokens(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), SPLIT), lambda x: x != "")


def tokenize(text: str) -> list[str]:
    return [x for x in re.split(r"[^\w]+", text.lower()) if x]


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    """English suffix stripping after Porter's published algorithm (1980)."""
    if len(word) <= 2 or not word.isascii():
        return word
    vowel = lambda w, i: w[i] in "aeiou" or (w[i] == "y" and i > 0 and not vowel(w, i - 1))

    def measure(w: str) -> int:
        kinds = "".join("v" if vowel(w, i) else "c" for i in range(len(w)))
        return len(re.findall("v+c+", kinds))

    has_vowel = lambda w: any(vowel(w, i) for i in range(len(w)))
    double = lambda w: len(w) > 1 and w[-1] == w[-2] and not vowel(w, len(w) - 1)
    cvc = lambda w: len(w) > 2 and not vowel(w, len(w) - 1) and vowel(w, len(w) - 2) and not vowel(w, len(w) - 3) and w[-1] not in "wxy"
    w = word
    for a, b in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(a):
            w = w[: len(w) - len(a)] + b
            break
    again = False
    if w.endswith("eed"):
        w = w[:-1] if measure(w[:-3]) > 0 else w
    elif w.endswith("ed") and has_vowel(w[:-2]):
        w, again = w[:-2], True
    elif w.endswith("ing") and has_vowel(w[:-3]):
        w, again = w[:-3], True
    if again:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif double(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif measure(w) == 1 and cvc(w):
            w += "e"
    if w.endswith("y") and has_vowel(w[:-1]):
        w = w[:-1] + "i"
    for table, least in ((STEP2, 0), (STEP3, 0)):
        for a, b in table:
            if w.endswith(a):
                if measure(w[: len(w) - len(a)]) > least:
                    w = w[: len(w) - len(a)] + b
                break
    for a in STEP4:
        if w.endswith(a):
            head = w[: len(w) - len(a)]
            if measure(head) > 1 and (a != "ion" or head[-1:] in ("s", "t")):
                w = head
            break
    if w.endswith("e") and (measure(w[:-1]) > 1 or (measure(w[:-1]) == 1 and not cvc(w[:-1]))):
        w = w[:-1]
    if measure(w) > 1 and double(w) and w[-1] == "l":
        w = w[:-1]
    return w


#: Suffix tables of the published algorithm (fixed values).
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def _stem_udf():
    """Stems of lists of words: each distinct word of an Arrow batch is stemmed once, the rest are lookups in Arrow."""

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def run(lists: pa.Array) -> pa.Array:
        words = lists.flatten()
        coded = words.dictionary_encode()
        stems = pa.array([stem(w) for w in coded.dictionary.to_pylist()], pa.string())
        sizes = np.asarray(lists.value_lengths().fill_null(0))
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype("int32")
        made = pa.ListArray.from_arrays(pa.array(ends), stems.take(coded.indices))
        return pc.if_else(lists.is_null(), pa.scalar(None, made.type), made) if lists.null_count else made

    return run


def tokens(c: Column, stemmed: bool = True, stopwords: list[str] | None = None) -> Column:
    """Lower-case words; stemmed in Arrow batches, since the JVM has no stemmer. Null gives null."""
    out = raw_tokens(c)
    if stopwords:
        out = F.filter(out, lambda x: ~x.isin(list(stopwords)))
    return _stem_udf()(out) if stemmed else out


def stopword_set(language_or_set, spark) -> frozenset[str]:
    """Stop words of a language name, a custom collection, or none."""
    if language_or_set is None:
        return frozenset()
    if isinstance(language_or_set, str):
        loader = spark.sparkContext._jvm.org.apache.spark.ml.feature.StopWordsRemover
        return frozenset(loader.loadDefaultStopWords(language_or_set))
    if isinstance(language_or_set, (set, list, tuple, frozenset)):
        if not all(isinstance(x, str) for x in language_or_set):
            raise TypeError("stop words must be strings")
        return frozenset(language_or_set)
    raise TypeError("stop words are a language name, a collection of strings or None")


def query_terms(text: str, stopwords: frozenset[str] = frozenset()) -> list[str]:
    """Query words: split at white space, commas and curly quotes stripped, lower case; duplicates are kept."""
    words = [w.strip().strip(",").replace("“", "").replace("”", "").lower() for w in text.split()]
    return [w for w in words if w and w not in stopwords]


def corpus_stats(df: DataFrame, tokens_col: str, terms: list[str]) -> tuple[int, float, dict[str, int]]:
    """Documents, mean length and document frequency of each term; one pass with partial aggregation, one row to the driver."""
    aggs = [F.count("*").alias("n"), F.avg(F.coalesce(F.size(tokens_col), F.lit(0))).alias("avg")]
    aggs += [F.sum(F.coalesce(F.array_contains(tokens_col, t), F.lit(False)).cast("long")).alias(f"t{i}") for i, t in enumerate(terms)]
    r = df.agg(*aggs).first()
    return int(r["n"] or 0), float(r["avg"] or 0.0), {t: int(r[f"t{i}"] or 0) for i, t in enumerate(terms)}


def term_frequency(tokens_col: str, term: str) -> Column:
    return F.size(F.filter(tokens_col, lambda x: x == term)).cast("double")


def score(tokens_col: str, terms: list[str], stats: tuple[int, float, dict[str, int]], scorer: str = "BM25STD", weights: dict[str, float] | None = None) -> Column:
    """Relevance of each row for ``terms``, from collection statistics gathered beforehand."""
    n, avg, freq = stats
    weights = weights or {}
    length = F.size(tokens_col).cast("double")
    if scorer == "DOCSCORE":
        return F.lit(1.0)
    if scorer == "HAMMING":
        raise ValueError("HAMMING needs payloads, which tables do not have")
    parts = []
    for t in dict.fromkeys(terms):
        times, w, tf = terms.count(t), float(weights.get(t, 1.0)), term_frequency(tokens_col, t)
        df = freq.get(t, 0)
        if scorer.startswith("BM25"):
            idf = math.log(1 + (n - df + 0.5) / (df + 0.5)) if n else 0.0
            parts.append(times * w * idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / F.lit(avg or 1.0))))
        elif scorer.startswith("TFIDF"):
            parts.append(times * w * tf * math.log2(1 + n / max(1, df)) / (F.greatest(length, F.lit(1.0)) if scorer.endswith("DOCNORM") else F.lit(1.0)))
        elif scorer == "DISMAX":
            parts.append(w * tf)
        else:
            raise ValueError(f"unknown scorer {scorer!r}")
    if not parts:
        return F.lit(0.0)
    if scorer == "DISMAX":
        return F.greatest(*parts) if len(parts) > 1 else parts[0]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.tanh(total / 4.0) if scorer.endswith("TANH") else total
