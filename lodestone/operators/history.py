"""Message history: recent and relevant messages of sessions."""

from __future__ import annotations

import json
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.functions import vectors as V

#: Roles that may be stored; ``llm`` is the old name of assistant (fixed values).
ROLES = ("user", "assistant", "system", "tool", "llm")
MESSAGES = "entry_id string, role string, content string, session_tag string, timestamp double, tool_call_id string, metadata string"
#: ``messages`` shows at most so many.
SHOWN = 1000


def check_roles(role: str | list[str] | None) -> list[str] | None:
    if role is None:
        return None
    roles = [role] if isinstance(role, str) else role
    if not isinstance(roles, list) or not roles:
        raise ValueError("role is a name or a non-empty list of names")
    for r in roles:
        if r not in ROLES:
            raise ValueError(f"unknown role {r!r}")
    return roles


class MessageHistory:
    def __init__(self, df: DataFrame | None = None, session: str | None = None, spark: SparkSession | None = None) -> None:
        self.session = session or uuid.uuid4().hex
        self.df = df if df is not None else (spark or SparkSession.active()).createDataFrame([], MESSAGES)

    def _of(self, session: str | None, role: str | list[str] | None) -> DataFrame:
        out = self.df.where(F.col("session_tag") == (session or self.session))
        roles = check_roles(role)
        if not roles:
            return out
        # the old name and the new one of assistant are one role
        same = {"llm", "assistant"}
        return out.where(F.col("role").isin(sorted(set(roles) | same if same & set(roles) else set(roles))))

    def add_messages(self, messages: list[dict[str, Any]], session: str | None = None, now: float | None = None) -> list[str]:
        import time

        tag, rows = session or self.session, []
        for k, m in enumerate(messages):
            check_roles(m["role"])
            t = (now if now is not None else time.time()) + k * 1e-6
            meta = m.get("metadata")
            rows.append((f"{tag}:{t}:{uuid.uuid4().hex[:8]}", m["role"], m["content"], tag, t, m.get("tool_call_id"), json.dumps(meta) if meta is not None else None))
        new = self.df.sparkSession.createDataFrame(rows, MESSAGES)
        self.df = self.df.unionByName(new, allowMissingColumns=True)
        return [r[0] for r in rows]

    def add_message(self, message: dict[str, Any], session: str | None = None, now: float | None = None) -> str:
        return self.add_messages([message], session, now)[0]

    def store(self, prompt: str, response: str, session: str | None = None, now: float | None = None) -> list[str]:
        return self.add_messages([{"role": "user", "content": prompt}, {"role": "assistant", "content": response}], session, now)

    def get_recent(self, top_k: int = 5, session: str | None = None, role: str | list[str] | None = None) -> DataFrame:
        """The latest ``top_k`` messages, oldest first."""
        if isinstance(top_k, bool) or not isinstance(top_k, int) or top_k < 0:
            raise ValueError("top_k is a whole number of at least 0")
        return self._of(session, role).orderBy(F.col("timestamp").desc(), F.col("entry_id").desc()).limit(top_k).orderBy("timestamp", "entry_id")

    def messages(self, session: str | None = None) -> DataFrame:
        return self._of(session, None).orderBy("timestamp", "entry_id").limit(SHOWN)

    def count(self, session: str | None = None) -> int:
        return self._of(session, None).count()

    def drop(self, ident: str | None = None, session: str | None = None) -> None:
        """The message of ``ident``, or else the latest one."""
        if ident is None:
            last = self.get_recent(1, session).head()
            ident = last["entry_id"] if last else None
        if ident is not None:
            self.df = self.df.where(F.col("entry_id") != ident)

    def clear(self, session: str | None = None) -> None:
        self.df = self.df.where(~F.coalesce(F.col("session_tag") == (session or self.session), F.lit(False)))

    def delete(self) -> None:
        self.df = self.df.limit(0)

    def get_relevant(self, vector: list[float], top_k: int = 5, distance_threshold: float = 0.3, fall_back: bool = False, session: str | None = None, role: str | list[str] | None = None, field: str = "vector_field") -> DataFrame:
        """Messages within the distance, nearest first; the recent ones where there are none and ``fall_back`` is set."""
        near = self._of(session, role).withColumn("vector_distance", V.cosine_distance(F.col(field), vector)).where(F.col("vector_distance") <= distance_threshold)
        near = near.orderBy("vector_distance", "entry_id").limit(top_k)
        if fall_back and near.isEmpty():
            return self.get_recent(top_k, session, role)
        return near


def recent_of_all(df: DataFrame, top_k: int = 5) -> DataFrame:
    """The latest ``top_k`` messages of every session. The rank limit is pushed below the shuffle, so a hot session sends
    ``top_k`` rows from each task."""
    w = Window.partitionBy("session_tag").orderBy(F.col("timestamp").desc(), F.col("entry_id").desc())
    return df.where(F.col("session_tag").isNotNull()).withColumn("recency", F.row_number().over(w)).where(F.col("recency") <= top_k)


def as_context(df: DataFrame, as_text: bool = False) -> list[Any]:
    """Messages for a prompt: texts, or role and content with tool id and metadata where present."""
    rows = df.collect()
    if as_text:
        return [r["content"] for r in rows]
    out = []
    for r in rows:
        m = {"role": r["role"], "content": r["content"]}
        if "tool_call_id" in r and r["tool_call_id"]:
            m["tool_call_id"] = r["tool_call_id"]
        if "metadata" in r and r["metadata"]:
            m["metadata"] = json.loads(r["metadata"])
        out.append(m)
    return out
