"""Problem 1: cutting oversized messages at natural boundaries.

Method: agglomerative merging. A text falls into atomic segments; neighbouring segments are held in a
heap by the strength of the boundary between them, and the weakest boundary is merged first while the
combined size plus the overlap fits. What is left are pieces whose edges lie at the strongest
boundaries that the limit allows.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import messages as M
from lodestone.plans.physical import bounded_broadcast

#: Boundaries from strong to weak; a cut lies after the match (fixed values).
BOUNDARIES = [
    (6, re.compile(r"(?:\r?\n)[ \t]*(?:\r?\n\s*)+")),
    (5, re.compile(r"\r\n|[\n\r\u2028\u2029]")),
    (4, re.compile(r"[.!?…。！？]+[\"'”’»)\]]*(?:\s+|(?<=[。！？]))")),
    (3, re.compile(r"[;:；：]\s+|[;；]")),
    (2, re.compile(r"[,，、]\s*")),
    (1, re.compile(r"\s+")),
]

PIECES = "entry_id string, role string, piece_no int, start_pos int, n_chars int, overlap_chars int, piece string"

#: size_limits is a parameter table; more scopes than this are no parameter table and are joined by shuffle.
LIMIT_ROWS = 10_000


def atoms(text: str, cap: int) -> tuple[list[int], list[int]]:
    """Cut positions (with 0 and the end) and the strength of the boundary at each; no atom exceeds ``cap``.

    Atoms are whole sentences; only a sentence over ``cap`` is cut further, at the weaker boundaries in
    turn and at last between characters. A finer start would give the same pieces, since weaker
    boundaries merge first.
    """
    cuts = {0: 9, len(text): 9}
    todo = [(0, len(text), 0)]
    while todo:
        a, b, level = todo.pop()
        if b - a <= cap and level > 2:
            continue
        if level == len(BOUNDARIES):
            cuts.update(dict.fromkeys(range(a + cap, b, cap), 0))
            continue
        strength, pattern = BOUNDARIES[level]
        last = a
        for m in pattern.finditer(text, a, b):
            if last < m.end() < b:
                cuts[m.end()] = strength
                todo.append((last, m.end(), level + 1))
                last = m.end()
        todo.append((last, b, level + 1))
    at = sorted(cuts)
    return at, [cuts[x] for x in at]


def split(text: str, max_size: int, overlap: int) -> list[tuple[int, int]]:
    """Core spans ``(start, end)`` that tile ``text``; with the overlap before it each is at most ``max_size``.

    A text within ``max_size`` is one span; an empty text gives none. ``max_size`` must be at least 1 and the overlap less; an
    overlap of the limit or more leaves no room and counts as one less than the limit. The first span holds at least
    as many characters as the overlap, so every later piece has the whole of it.
    """
    if max_size < 1:
        raise ValueError("max_size must be at least 1")
    if not text:
        return []
    if len(text) <= max_size:
        return [(0, len(text))]
    overlap = min(max(overlap, 0), max_size - 1)
    cap = max_size - overlap
    spans = merged(text[overlap:], cap)
    return [(a + overlap if k else 0, b + overlap) for k, (a, b) in enumerate(spans)]


def merged(text: str, cap: int) -> list[tuple[int, int]]:
    """Spans of at most ``cap`` characters that tile ``text``, merged over the weakest boundaries."""
    at, strength = atoms(text, cap)
    n = len(at) - 1
    start, end = at[:-1], at[1:]
    nxt, prv, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(strength[i + 1], end[i + 1] - start[i], i, i + 1) for i in range(n - 1) if end[i + 1] - start[i] <= cap]
    heapq.heapify(heap)
    while heap:
        s, size, i, j = heapq.heappop(heap)
        if not (live[i] and j < n and live[j] and nxt[i] == j and end[j] - start[i] == size):
            continue
        end[i], live[j], nxt[i] = end[j], False, nxt[j]
        if nxt[i] < n:
            prv[nxt[i]] = i
            k = nxt[i]
            if end[k] - start[i] <= cap:
                heapq.heappush(heap, (strength_at(at, strength, start[k]), end[k] - start[i], i, k))
        p = prv[i]
        if p >= 0 and end[i] - start[p] <= cap:
            heapq.heappush(heap, (strength_at(at, strength, start[i]), end[i] - start[p], p, i))
    return [(start[i], end[i]) for i in range(n) if live[i]]


def strength_at(at: list[int], strength: list[int], position: int) -> int:
    lo, hi = 0, len(at)
    while lo < hi:
        mid = (lo + hi) // 2
        if at[mid] < position:
            lo = mid + 1
        else:
            hi = mid
    return strength[lo]


def pieces(chat: DataFrame, limits: DataFrame) -> DataFrame:
    """The pieces of every message of ``chat`` longer than the limit of its role.

    Input: entry_id, role, content, ingested_at; limits: scope, max_size, overlap_size. Output: see
    ``PIECES``; ``start_pos`` counts characters from 1 and ``overlap_chars`` is what the piece shares with
    the one before it: as stated, one less than the limit if that is less, none if null.

    Null or short contents, messages without entry_id and scopes without a limit give no rows; repeated
    rows count once; a role that names none uses the scope ``other``. Extra columns are ignored.
    """
    sized = limits.where(F.col("scope").startswith("chat_messages.")).groupBy(F.substring_index("scope", ".", -1).alias("_role")).agg(
        F.min("max_size").alias("max_size"), F.min_by("overlap_size", "max_size").alias("overlap_size")
    )
    least = limits.where(F.col("scope").startswith("chat_messages.")).agg(F.min("max_size")).first()[0]
    long = chat.select("entry_id", M.clean_role(F.col("role")).alias("role"), "content", "ingested_at")
    long = long.where(F.length("content") > F.lit(least))
    one = M.one_per_entry(long, ["content"])
    joined = one.withColumn("_role", F.coalesce("role", F.lit("other"))).join(bounded_broadcast(sized, LIMIT_ROWS), "_role")
    over = joined.where(F.length("content") > F.col("max_size"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, role, text, size, overlap in batch.itertuples(index=False):
                overlap = 0 if pd.isna(overlap) else min(max(int(overlap), 0), int(size) - 1)
                for k, (a, b) in enumerate(split(text, int(size), overlap)):
                    shared = min(overlap, a)
                    rows.append((key, role, k + 1, a - shared + 1, b - a + shared, shared, text[a - shared : b]))
            yield pd.DataFrame(rows, columns=["entry_id", "role", "piece_no", "start_pos", "n_chars", "overlap_chars", "piece"])

    return over.select("entry_id", "role", "content", "max_size", "overlap_size").mapInPandas(cut, PIECES)


def found(chat: DataFrame, limits: DataFrame) -> DataFrame:
    """``entry_id`` of each message that was cut."""
    return pieces(chat, limits).where("piece_no = 2").select("entry_id")
