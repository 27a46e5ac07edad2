"""Problem 5: rebuilding conversations from message rows.

Method: disentangling interleaved channels. Messages are put in order; each scores the messages before it that it may
speak to by time, mentions and lexical overlap, takes the likeliest as its parent, and the links form trees:

- a prompt that follows a prompt *continues* it, so a run of prompts is a chain with a head;
- a reply *replies* to the likeliest prompt or tool result of the last ``HORIZON_S`` seconds, or, where that long nothing
  was said, to the last prompt before it;
- another prompt *follows up* the likeliest reply of that time if it mentions it or shares enough words, else it begins a tree;
- a tool message belongs to the assistant message with its call, wherever in the conversation that is.

The score of a link is ``exp(-gap / DECAY_S) * (1 + overlap weight * overlap + mention weight * mentions)``, so what lies beyond the
horizon could win only against nothing. Each reply also knows the head of the prompts right before it. A conversation is
dropped by its links: no link end that is not blank, a reply without any prompt or a tool message without its call, a head that no
visible reply follows. An exact check of runs is part of the last: it counts heads and the first visible replies right after them.

No task holds a whole conversation: the order is dealt by ranges of (session, time), see ``OrderedScan``; rows within the
horizon of a bound are sent along, and the state at a bound is folded from one small state for each partition.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm import messages as M
from lodestone.plans.physical import OrderedScan, stage_table

#: Seconds after which the weight of time has fallen to 1/e, and beyond which a link is made only where there is no other.
DECAY_S, HORIZON_S = 600.0, 1800.0
#: Weights of lexical overlap and mention.
OVERLAP_WEIGHT, MENTION_WEIGHT = 0.8, 2.0
#: The share of common words from which a prompt follows up a reply.
FOLLOW_UP = 0.5

LINKED = (
    "entry_id string, session_tag string, position long, role string, t double, rank int, seen boolean, tool_call_id string, "
    "parent_id string, link string, link_score double, head_id string, is_head boolean, answers boolean, unprompted boolean"
)


def word_hashes(content: Column) -> Column:
    """Every distinct word of four letters or more, as its hash."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(content), F.lit(r"(\p{L}{4,})"), 1))
    return F.transform(words, lambda w: F.hash(w))


def mention_hashes(content: Column, call: Column) -> Column:
    """What a text points at: names after @, identifiers with a digit, quoted words, and its tool call; as hashes."""
    said = F.regexp_extract_all(F.lower(content), F.lit(r"(@[\p{L}\d._-]{2,}|(?<![\p{L}\d])[\p{L}\d]*\d[\p{L}\d_-]{3,}|(?<=[`\"“«])[^`\"”»\n]{3,40}(?=[`\"”»]))"), 1)
    own = F.when(call.isNotNull(), F.array(F.concat(F.lit("call "), call))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array_distinct(F.concat(F.coalesce(said, F.array().cast("array<string>")), own)), lambda w: F.hash(w))


def ordering(chat: DataFrame) -> DataFrame:
    return chat.select(
        "entry_id",
        M.clean_role(F.col("role")).alias("role"),
        M.clean_tag(F.col("session_tag")).alias("session_tag"),
        M.clean_time(F.col("timestamp"), F.col("entry_id")).alias("t"),
        M.visible(F.col("content")).alias("seen"),
        "tool_call_id",
        F.coalesce(word_hashes(F.col("content")), F.array().cast("array<int>")).alias("words"),
        mention_hashes(F.col("content"), F.col("tool_call_id")).alias("mentions"),
        "ingested_at",
    ).where(F.col("session_tag").isNotNull() & F.col("entry_id").isNotNull())


def prepared(chat: DataFrame) -> DataFrame:
    """One row for each message of a conversation, with the hashes of its words and mentions; contents stay behind."""
    one = M.one_per_entry(ordering(chat), ["session_tag", "t", "seen", "tool_call_id", "words", "mentions"])
    return one.withColumn("rank", M.role_rank(F.col("role")))


NOTHING = {"first": None, "last": None, "lead": None, "head": None, "seen": False, "prompt": None}


def _step(s: dict, key: str, role: str, seen: bool, t: float) -> dict:
    """The state after one more message: the first and last role of a stretch of one conversation, the head of its last prompts
    (``lead`` if these are its very first rows), whether a visible reply followed them, and its last prompt."""
    if role == "user":
        if s["last"] is None:
            return {**s, "first": "user", "last": "user", "lead": key, "prompt": (key, t)}
        if s["last"] != "user":
            return {**s, "last": "user", "head": key, "seen": False, "prompt": (key, t)}
        return {**s, "prompt": (key, t)}
    if role == "assistant":
        return {**s, "first": s["first"] or "assistant", "last": "assistant", "seen": s["seen"] or bool(seen)}
    return s


def _fold(state: dict | None, rows: pd.DataFrame) -> dict:
    s = state or NOTHING
    for key, role, seen, t in zip(rows["entry_id"], rows["role"], rows["seen"], rows["t"]):
        s = _step(s, key, role, seen, t)
    return s


def _merge(a: dict, b: dict) -> dict:
    if b["first"] is None:
        return a
    if a["first"] is None:
        return b
    out = {**a, "last": b["last"], "prompt": b["prompt"] or a["prompt"]}
    if b["head"] is not None:
        out["head"], out["seen"] = b["head"], b["seen"]
    elif b["first"] == "user" and a["last"] != "user":
        out["head"], out["seen"] = b["lead"], b["seen"]
    elif b["first"] == "user":
        out["seen"] = b["seen"]
    else:
        out["seen"] = a["seen"] or b["seen"]
    return out


def _head(state: dict | None) -> str | None:
    """The head of the last prompts, from the state of a conversation from its beginning."""
    return None if state is None else state["head"] if state["head"] is not None else state["lead"]


class _Row:
    """Columns of one batch and its context, as plain lists."""

    def __init__(self, rows: pd.DataFrame) -> None:
        self.key, self.tag, self.role = (rows[c].tolist() for c in ("entry_id", "session_tag", "role"))
        self.t, self.seen = rows["t"].to_numpy("float64"), rows["seen"].tolist()
        self.words, self.mentions = ([frozenset(w.tolist() if isinstance(w, np.ndarray) else w or ()) for w in rows[c]] for c in ("words", "mentions"))

    def overlap(self, i: int, j: int) -> float:
        return len(self.words[i] & self.words[j]) / max(1, min(len(self.words[i]), len(self.words[j])))

    def likeliest(self, i: int, among: list[int]) -> tuple[int, float]:
        """The best-scored of ``among`` (in order of time) as parent of row ``i``, and its score. The walk goes back in time and ends where
        time alone puts all that is left below the best so far, so nothing within the horizon is missed."""
        best, score, top = -1, -1.0, 1 + OVERLAP_WEIGHT + MENTION_WEIGHT
        for j in reversed(among):
            gap = self.t[i] - self.t[j]
            if gap > HORIZON_S:
                break
            near = float(np.exp(-(0.0 if gap != gap else max(gap, 0.0)) / DECAY_S))
            if near * top <= score:
                break
            got = near * (1 + OVERLAP_WEIGHT * self.overlap(i, j) + MENTION_WEIGHT * bool(self.mentions[i] & self.mentions[j]))
            if got > score:
                best, score = j, got
        return best, score


def _link(rows: pd.DataFrame, n: int, position: np.ndarray, state: dict | None) -> tuple[pd.DataFrame, dict]:
    r, out = _Row(rows), []
    tag, asked, prompts, said = None, [], [], []
    for i, (key, role) in enumerate(zip(r.key, r.role)):
        if r.tag[i] != tag:
            tag, asked, prompts, said = r.tag[i], [], [], []
            if i > n:
                state = None
        if i >= n:
            before, parent, link, score, is_head, answers, unprompted = state, None, None, None, False, False, False
            state = _step(state or NOTHING, key, role, r.seen[i], r.t[i])
            if role == "user":
                if before and before["last"] == "user":
                    parent, link = before["prompt"][0], "continues"
                else:
                    is_head = True
                    j, score = r.likeliest(i, said)
                    if j >= 0 and (r.mentions[i] & r.mentions[j] or r.overlap(i, j) >= FOLLOW_UP):
                        parent, link = r.key[j], "follows up"
                    else:
                        score = None
            elif role in ("assistant", "tool"):
                j, score = r.likeliest(i, prompts if role == "tool" else asked)
                if j >= 0:
                    parent, link = r.key[j], "replies"
                elif before and before["prompt"]:
                    parent, link, score = before["prompt"][0], "replies late", 0.0
                else:
                    score = None
                if role == "assistant":
                    unprompted = _head(before) is None
                    answers = bool(r.seen[i]) and not unprompted and not before["seen"]
            out.append((position[i - n], parent, link, score, _head(state), is_head, answers, unprompted))
        if role == "user":
            prompts.append(i)
        if role in ("user", "tool"):
            asked.append(i)
        elif role == "assistant":
            said.append(i)
    made = pd.DataFrame(out, columns=["position", "parent_id", "link", "link_score", "head_id", "is_head", "answers", "unprompted"])
    kept = rows.iloc[n:][["entry_id", "session_tag", "role", "t", "rank", "seen", "tool_call_id"]].reset_index(drop=True)
    return pd.concat([kept, made], axis=1)[[x.split()[0] for x in LINKED.split(", ")]], state


def trees(linked: DataFrame) -> DataFrame:
    """``entry_id, tree_id``: the root of each message's tree. Pointers are doubled until none moves, so a chain of n links takes log n joins."""
    at = stage_table(linked.select("session_tag", "entry_id", F.coalesce("parent_id", "entry_id").alias("tree_id"), F.col("parent_id").isNull().alias("done")))
    while not at.where(~F.col("done")).isEmpty():
        up = at.select("session_tag", F.col("entry_id").alias("tree_id"), F.col("tree_id").alias("above"), F.col("done").alias("above_done"))
        # roots and what hangs on a root are done: only the others take part
        open_ = at.where(~F.col("done")).join(up, ["session_tag", "tree_id"]).select("session_tag", "entry_id", F.col("above").alias("tree_id"), F.col("above_done").alias("done"))
        at = stage_table(at.where("done").unionByName(open_))
    return at.select("session_tag", "entry_id", "tree_id")


@dataclass
class Conversations:
    """``messages``: every message in order with its parent, and the head of the prompts that it comes after. ``verdicts``: each
    conversation with the reason to drop it, null for those that are kept."""

    messages: DataFrame
    verdicts: DataFrame

    @property
    def dropped(self) -> DataFrame:
        return self.verdicts.where(F.col("reason").isNotNull())

    @property
    def kept(self) -> DataFrame:
        """The messages of the kept conversations; ordered by session_tag and position."""
        return self.messages.join(self.dropped.select("session_tag"), "session_tag", "left_anti")

    @property
    def with_trees(self) -> DataFrame:
        """The messages of the kept conversations with ``tree_id``, the root of their link tree."""
        kept = stage_table(self.kept)
        return kept.join(trees(kept), ["session_tag", "entry_id"])


def rebuild(chat: DataFrame) -> Conversations:
    """Ordered conversations with clean roles, and the reasons to drop those that are empty, broken or lack a reply.

    Input: entry_id, role, content, session_tag, timestamp, tool_call_id, ingested_at; other columns are
    ignored. Repeated rows of one entry_id count once, rows without entry_id or session tag belong to no
    conversation. Messages are ordered by time, then system, user, tool, assistant, no role, then entry_id;
    messages that have no time at all come first. Null and invisible contents are blank. A tool message
    without tool_call_id is on no assistant message, so it breaks its conversation. An empty table gives
    empty results. Of equally likely parents the latest is taken.
    """
    keys = ordering(chat).where("session_tag IS NOT NULL AND entry_id IS NOT NULL").select("session_tag", "t", M.role_rank(F.col("role")).alias("rank"), "entry_id")
    scan = OrderedScan(prepared(chat), "session_tag", ["t", "rank", "entry_id"], HORIZON_S, keys).looking_back("t", HORIZON_S)
    linked = stage_table(scan.map(_link, LINKED, _fold, _merge))
    tools = linked.where(F.col("role") == "tool").select("session_tag", F.coalesce("tool_call_id", F.lit("")).alias("call")).distinct()
    calls = linked.where((F.col("role") == "assistant") & F.col("tool_call_id").isNotNull()).select("session_tag", F.col("tool_call_id").alias("call"))
    orphans = tools.join(calls, ["session_tag", "call"], "left_anti").select("session_tag").distinct().withColumn("orphan", F.lit(True))
    whole = linked.groupBy("session_tag").agg(
        F.max(F.col("seen") & F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))).alias("any_seen"), F.max(F.col("role").isNull()).alias("no_role"),
        F.max("unprompted").alias("unprompted"), F.sum(F.col("is_head").cast("long")).alias("heads"), F.sum(F.col("answers").cast("long")).alias("answered"),
    )
    reason = (
        F.when(~F.col("any_seen"), "empty")
        .when(F.col("unprompted") | F.col("no_role") | F.coalesce("orphan", F.lit(False)), "broken")
        .when(F.col("heads") > F.col("answered"), "missing_reply")
    )
    verdicts = whole.join(orphans, "session_tag", "left").select("session_tag", reason.alias("reason"))
    return Conversations(linked, verdicts)


def found(chat: DataFrame) -> DataFrame:
    return rebuild(chat).dropped
