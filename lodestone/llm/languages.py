"""Problem 8: missing or wrong document language labels, and texts that mix languages.

Method: Bayesian evidence fusion. Each segment of a text (a sentence, heading or line) gets the likelihood of every
language. The posterior of the document multiplies those of its segments with its declared label (weighted by how labels
agree with texts in the whole table), the suffix of its address and a prior of its source, smoothed from source to
host to the whole table by grouped aggregation. The posterior of a segment is its own likelihood times that of the
document, of which a share ``SWITCH`` is spread over all languages, since a text may change its language. ``found`` and ``labels``
both read these two posteriors: the language of a document in one language is the likeliest of the document, and a language with
two or more sentences by the posteriors of segments is spoken.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import langid
from lodestone.llm.langid import LANGS
from lodestone.plans.physical import bounded_broadcast, stage_table

#: Labels of each language in lower case, besides the two letters and those with a region (fixed values).
LABELS = {
    "en": ["eng", "english"],
    "de": ["deu", "ger", "german", "deutsch"],
    "fr": ["fra", "fre", "french", "français", "francais"],
    "es": ["spa", "spanish", "español", "espanol"],
    "pt": ["por", "portuguese", "português", "portugues"],
    "it": ["ita", "italian", "italiano"],
    "nl": ["nld", "dut", "dutch", "nederlands"],
    "ru": ["rus", "russian", "русский"],
    "ja": ["jpn", "japanese", "日本語"],
}
#: Labels that name no language (fixed values).
NO_LABEL = ["", "und", "xx", "n/a", "na", "unknown", "auto", "??", "?", "none", "null", "zxx", "mul", "mis", "-", "other", "undefined"]
#: Address suffixes that hint at a language (fixed values).
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "pt": "pt", "br": "pt", "it": "it", "nl": "nl", "ru": "ru", "jp": "ja", "uk": "en", "us": "en"}

#: Share of segments that are expected in another language than the document's.
SWITCH = 0.2
#: Nats by which the likeliest language of a segment must lead.
LEAD_NATS = 2.0
#: Nats by which one segment can speak against a language at most.
FLOOR = 24.0
#: Pseudo-documents with which a source leans on its host, and a host on the whole table.
SMOOTHING = 20.0
#: Sources beyond this number are joined by shuffle.
SOURCE_ROWS = 200_000
#: Words and margin in nats from which a segment is language at all, whatever the document says.
SURE_WORDS, SURE_NATS = 3, 5.0

FENCE = re.compile(r"```.*?(?:```|\Z)|`[^`\n]*`", re.S)
ENDS = re.compile(r"[.!?…]+[\"'”’»)\]]*(?=\s)|[。！？]+[」』）]*|[\r\n]+")
MARKS = re.compile(r"^\s*(?:[>#*\-+<|]+\s*|\[\d+\]\s*|\d+[.)]\s+|[A-Z]:\s+)+")
CODE = re.compile(r"\w\([^()]*\)\s*$|[{}=\\]|\w_\w|://")
#: No code without one of these.
CODE_SIGNS = re.compile(r"[({}=\\_/]")
STATEMENT = re.compile(r"\s*(?:select|from|where|group by|limit|export|import)\b.*[^.]$")
PARTS = "doc_id long, part_no int, start_pos int, n_chars int, lang string, confidence double"
SCORED = "doc_id long, lang string, source string, length int, scores array<double>, starts array<int>, words array<short>, nats array<short>"
JUDGED = "doc_id long, declared string, best string, confidence double, spoken array<string>, parts array<struct<a:int,b:int,lang:string,c:double>>"
#: Nats are kept in tenths.
UNIT = 10.0

def segments(text: str) -> list[tuple[int, int, str]]:
    """Spans of sentences, headings and lines with what is left of them once code, marks and asides are blanked."""
    blank = lambda m: re.sub(r"[^\n]", " ", m.group())
    clean = FENCE.sub(blank, text)
    out, a = [], 0
    for m in ENDS.finditer(clean):
        out.append((a, m.end()))
        a = m.end()
    out.append((a, len(clean)))
    kept = []
    for a, b in out:
        s = clean[a:b]
        m = MARKS.match(s)
        body = (s[m.end() :] if m else s).strip()
        if body and not (CODE_SIGNS.search(body) and CODE.search(body)) and not STATEMENT.match(body) and not (body[0] in "([" and body[-1] in ")]"):
            kept.append((a, b, body))
    return kept


def likelihoods(texts: list[str]) -> tuple[list[list[tuple[int, int, str]]], np.ndarray, np.ndarray, np.ndarray]:
    """Segments of each text; and for all of them in a row nats below the likeliest language, words, and whether they are language."""
    spans = [segments(t) for t in texts]
    flat = [s for x in spans for _, _, s in x]
    sc, n = langid.text_scores(flat)
    if not len(flat):
        return spans, sc, n, np.zeros(0, bool)
    top = np.partition(sc, -2, axis=1)
    best = sc.argmax(axis=1)
    letters = np.zeros(len(flat), int)
    for i in np.flatnonzero(best >= 8):
        letters[i] = len(langid.KANA.findall(flat[i]))
    bearing = ((n >= SURE_WORDS) & (top[:, -1] - top[:, -2] >= SURE_NATS)) | (letters >= 4) | ((best == 7) & (n >= 2))
    nats = np.maximum(sc - sc.max(axis=1, keepdims=True), -FLOOR)
    nats[(n < 2) & (letters < 4)] = 0
    return spans, nats, np.where(letters >= 4, np.maximum(n, SURE_WORDS), n), bearing


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def posteriors(nats: np.ndarray, sizes: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each document and of each segment. ``sizes``: segments of each document, one at least; ``outer``: nats of all other evidence."""
    starts = np.cumsum(sizes) - sizes
    whole = softmax(outer + np.add.reduceat(nats, starts, axis=0))
    prior = (1 - SWITCH) * whole + SWITCH / whole.shape[1]
    return whole, softmax(nats + np.log(np.repeat(prior, sizes, axis=0)))


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = np.array(LANGS)
    for batch in batches:
        if not len(batch):
            continue
        sizes = batch["starts"].map(len).to_numpy()
        nats = np.concatenate(batch["nats"].to_numpy()).reshape(-1, len(LANGS)) / UNIT
        words = np.concatenate(batch["words"].to_numpy())
        whole, each = posteriors(nats, sizes, np.stack(batch["outer"].to_numpy()))
        top = np.partition(each, -2, axis=1)
        sure = (words >= SURE_WORDS) & (np.log(top[:, -1]) - np.log(np.maximum(top[:, -2], 1e-300)) >= LEAD_NATS)
        best, lead, rows, at = each.argmax(axis=1), whole.argmax(axis=1), [], 0
        for i, (n, starts, length) in enumerate(zip(sizes, batch["starts"], batch["length"])):
            own = slice(at, at + n)
            count = np.bincount(best[own][sure[own]], minlength=len(LANGS))
            spoken = np.flatnonzero(count >= 2)
            parts = []
            if len(spoken) > 1:
                # runs of segments in one language; what is unsure belongs to the run before it, so that parts tile the text
                runs: list[list[int]] = []
                for k in range(at, at + n):
                    if sure[k] and count[best[k]] >= 2 and (not runs or runs[-1][1] != best[k]):
                        runs.append([k, best[k]])
                for r, (k, lang) in enumerate(runs):
                    end = runs[r + 1][0] if r + 1 < len(runs) else at + n
                    mine = softmax(nats[k:end].sum(axis=0, keepdims=True) + np.log((1 - SWITCH) * whole[i] + SWITCH / len(LANGS)))[0]
                    parts.append({"a": int(starts[k - at]) if r else 0, "b": int(starts[end - at]) if r + 1 < len(runs) else int(length), "lang": LANGS[lang], "c": float(mine[lang])})
            rows.append((float(whole[i, lead[i]]), names[spoken].tolist(), parts))
            at += n
        out = pd.DataFrame(rows, columns=["confidence", "spoken", "parts"])
        yield pd.DataFrame({"doc_id": batch["doc_id"].to_numpy(), "declared": batch["declared"].to_numpy(), "best": names[lead], **out})


def declared(lang: Column) -> Column:
    """The two letters that a label names; null if it names none, ``other`` if it names a language we do not know."""
    low = F.lower(F.trim(F.regexp_replace(lang, r"[\s\p{Z}]+", " ")))
    head = F.regexp_extract(low, r"^([a-z]{2})(?:[-_].*)?$", 1)
    out = F.when(head.isin(LANGS), head).otherwise(F.lit("other"))
    for k, names in LABELS.items():
        out = F.when(F.element_at(F.split(low, "[-_]"), 1).isin(names), F.lit(k)).otherwise(out)
    return F.when(low.isNull() | low.isin(NO_LABEL), F.lit(None).cast("string")).otherwise(out)


def scored(docs: DataFrame) -> DataFrame:
    """One row for each text with language in it: its segments and what each says of every language."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spans, nats, words, bearing = likelihoods(batch["text"].tolist())
            sizes = np.array([len(x) for x in spans], int)
            at = np.cumsum(sizes) - sizes
            keep = np.array([i for i in range(len(spans)) if sizes[i] and bearing[at[i] : at[i] + sizes[i]].any()], int)
            if not len(keep):
                continue
            short = np.round(nats * UNIT).astype("int16")
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].to_numpy()[keep], "lang": batch["lang"].to_numpy()[keep], "source": batch["source"].to_numpy()[keep], "length": [len(batch["text"].iat[i]) for i in keep],
                "scores": [nats[at[i] : at[i] + sizes[i]].sum(axis=0, dtype="float64") for i in keep], "starts": [[a for a, _, _ in spans[i]] for i in keep],
                "words": [np.minimum(words[at[i] : at[i] + sizes[i]], 30000).astype("int16") for i in keep], "nats": [short[at[i] : at[i] + sizes[i]].ravel() for i in keep],
            })

    rows = docs.where(F.col("text").isNotNull() & F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source")
    return rows.mapInPandas(run, SCORED)


def priors(rows: DataFrame) -> DataFrame:
    """log prior of each language for each source: source counts smoothed by the host, the host by the whole table."""
    sums = lambda: [F.sum(F.when(F.col("guess") == i, 1.0).otherwise(0.0)).alias(f"n{i}") for i in range(len(LANGS))]
    by_source = rows.groupBy("source", "host").agg(*sums())
    fold = lambda: [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(LANGS))]
    by_host = by_source.groupBy("host").agg(*fold())
    total = by_host.agg(*fold()).first()
    whole = np.array([total[i] or 0.0 for i in range(len(LANGS))]) + 1.0
    whole /= whole.sum()

    def smooth(names: list[str], base: list[Column]) -> list[Column]:
        n = sum((F.col(x) for x in names[1:]), F.col(names[0]))
        return [(F.col(x) + SMOOTHING * p) / (n + SMOOTHING) for x, p in zip(names, base)]

    names = [f"n{i}" for i in range(len(LANGS))]
    host = by_host.select("host", F.array(*smooth(names, [F.lit(float(x)) for x in whole])).alias("host_p"))
    joined = by_source.join(bounded_broadcast(host, SOURCE_ROWS), "host")
    return joined.select("source", F.array(*[F.log(x) for x in smooth(names, [F.col("host_p")[i] for i in range(len(LANGS))])]).alias("prior"))


def fused(docs: DataFrame) -> DataFrame:
    """One row for each text that holds at least a sentence or heading; see ``JUDGED``."""
    kept = stage_table(scored(docs))
    s = F.col("scores")
    rows = kept.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("source"), F.substring_index(F.coalesce("source", F.lit("")), "/", 1).alias("host"),
        declared(F.col("lang")).alias("declared"), (F.array_position(s, F.array_max(s)) - 1).cast("int").alias("guess"), "length", "starts", "words", "nats",
    )
    # how often a label names the language that the text speaks for: at most 10 x 10 numbers
    counts = np.full((len(LANGS), len(LANGS)), 0.5)
    for r in rows.where(F.col("declared").isNotNull()).groupBy("declared", "guess").count().collect():
        counts[LANGS.index(r["declared"]), r["guess"]] += r["count"]
    label_log = np.log(counts / counts.sum(axis=0))
    label = F.array(*[F.lit(0.0)] * len(LANGS))
    for i, k in enumerate(LANGS):
        label = F.when(F.col("declared") == k, F.array(*[F.lit(float(x)) for x in label_log[i]])).otherwise(label)
    suffix = F.regexp_extract(F.col("host"), r"\.([a-z]{2})$", 1)
    hint = F.array(*[F.when(suffix.isin([k for k, v in SUFFIXES.items() if v == lang]), 1.0).otherwise(0.0) for lang in LANGS])
    outer = F.zip_with(F.zip_with("prior", label, lambda x, y: x + y), hint, lambda x, y: x + y)
    total = rows.join(bounded_broadcast(priors(rows), SOURCE_ROWS), "source")
    return total.select("doc_id", "declared", outer.alias("outer"), "length", "starts", "words", "nats").mapInPandas(_judge, JUDGED)


def labels(docs: DataFrame) -> DataFrame:
    """Language and confidence of every text, or of each segment where a text mixes languages.

    Input: doc_id, text, lang, source; other columns are ignored. Output: see ``PARTS``; ``start_pos``
    counts characters from 1. The parts of a text tile it: a text in one language is one part, and in a mixed one what is no
    language or in doubt belongs to the part before it. Languages are two letters, or ``other``. Null, empty and language-free texts
    (numbers, ids, code) give one part with null language and confidence 0. Rows with null doc_id are
    dropped; repeated rows give their parts once for each row; an empty table gives no rows.
    """
    f = fused(docs)
    base = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.length("text"), F.lit(0)).alias("length"))
    joined = base.join(f.dropDuplicates(["doc_id"]), "doc_id", "left")
    one = F.array(F.struct(F.lit(0).alias("a"), F.col("length").alias("b"), F.col("best").alias("lang"), F.coalesce("confidence", F.lit(0.0)).alias("c")))
    parts = F.when(F.size("parts") > 0, F.col("parts")).otherwise(one)
    return joined.select("doc_id", F.posexplode(parts)).select(
        "doc_id", (F.col("pos") + 1).alias("part_no"), (F.col("col.a") + 1).alias("start_pos"), (F.col("col.b") - F.col("col.a")).alias("n_chars"),
        F.col("col.lang").alias("lang"), F.col("col.c").alias("confidence"),
    )


def found(docs: DataFrame) -> DataFrame:
    """Texts with a missing or wrong label, and texts that mix languages (a row for each language). ``lang_found`` is ``xx`` for
    a language that the model does not know; a label that names any such language is right for it."""
    f, one, mixed = fused(docs), F.col("best"), F.size("spoken") >= 2
    issue = F.when(mixed, "mixed").when(F.col("declared").isNull(), "missing").when(F.col("declared") != one, "wrong")
    rows = f.select("doc_id", issue.alias("issue"), F.when(mixed, F.col("spoken")).otherwise(F.array(one)).alias("langs")).where(F.col("issue").isNotNull())
    return rows.select("doc_id", "issue", F.explode("langs").alias("lang_found")).distinct().replace("other", "xx", ["lang_found"])
