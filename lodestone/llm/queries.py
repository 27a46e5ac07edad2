"""Queries of the operators in this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.sources.tables import table as T


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import chunking

    return chunking.found(T(spark, d, "chat_messages"), T(spark, d, "size_limits"))


def p1_pieces(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import chunking

    return chunking.pieces(T(spark, d, "chat_messages"), T(spark, d, "size_limits"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import pii

    return pii.found(T(spark, d, "chat_messages"))


def p2_redacted(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import pii

    return pii.redacted(T(spark, d, "chat_messages"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import answers

    return answers.found(T(spark, d, "chat_messages"))


def p3_defects(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import answers

    return answers.defects(T(spark, d, "chat_messages"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import neighbours

    return neighbours.found(T(spark, d, "chat_messages"), T(spark, d, "sentence_vectors"))


def p4_nearest(spark: SparkSession, d: str) -> DataFrame:
    """The ten most similar others of each vector."""
    from lodestone.llm import neighbours

    parts = [("chat_messages", "entry_id", "vector_field"), ("sentence_vectors", "record_key", "embedding")]
    a, b = (neighbours.nearest(T(spark, d, t), k, v).select(F.lit(t).alias("table_name"), "key", "neighbour", "distance", "nth") for t, k, v in parts)
    return a.unionByName(b)


def p4_recall(spark: SparkSession, d: str) -> DataFrame:
    """The share of true neighbours among those of ``p4_nearest``, over the keys whose hash is divisible by 50 against all rows."""
    from lodestone.llm import neighbours

    parts = [("chat_messages", "entry_id", "vector_field"), ("sentence_vectors", "record_key", "embedding")]
    a, b = (neighbours.recall(T(spark, d, t), k, v).select(F.lit(t).alias("table_name"), "asked", "recall") for t, k, v in parts)
    return a.unionByName(b)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import conversations

    return conversations.found(T(spark, d, "chat_messages"))


def p5_conversations(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import conversations

    kept = conversations.rebuild(T(spark, d, "chat_messages")).with_trees
    return kept.select("session_tag", "position", "entry_id", "role", "t", "parent_id", "link", "tree_id")


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import tokens

    return tokens.encode(T(spark, d, "documents"))


def p6_decoded(spark: SparkSession, d: str) -> DataFrame:
    """The round trip: ids back to texts."""
    from lodestone.llm import tokens

    return tokens.decode(tokens.encode(T(spark, d, "documents")))


def p7_packed(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import packing

    return packing.packed(T(spark, d, "documents"), T(spark, d, "size_limits"))


def p7_each_capacity(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import packing

    return packing.packed(T(spark, d, "documents"), T(spark, d, "size_limits"), each=True)


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and share unused for each capacity."""
    from lodestone.llm import packing

    return packing.fill(packing.packed(T(spark, d, "documents"), T(spark, d, "size_limits")))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import languages

    return languages.found(T(spark, d, "documents"))


def p8_labels(spark: SparkSession, d: str) -> DataFrame:
    from lodestone.llm import languages

    return languages.labels(T(spark, d, "documents"))


ROLE_SQL = """CASE lower(trim({0})) WHEN 'user' THEN 'user' WHEN 'human' THEN 'user'
 WHEN 'assistant' THEN 'assistant' WHEN 'llm' THEN 'assistant' WHEN 'ai' THEN 'assistant' WHEN 'bot' THEN 'assistant'
 WHEN 'system' THEN 'system' WHEN 'tool' THEN 'tool' WHEN 'function' THEN 'tool' END"""

P1_SQL = f"""
WITH m AS (SELECT entry_id, max({ROLE_SQL.format("role")}) AS role, max(length(content)) AS n FROM chat_messages GROUP BY entry_id)
SELECT m.entry_id FROM m JOIN size_limits l ON l.scope = 'chat_messages.' || coalesce(m.role, 'other') WHERE m.n > l.max_size
"""


SEEN_SQL = r"length(regexp_replace(coalesce(content, ''), '[\s\p{Z}\p{C}]', '', 'g')) > 0"
P5_SQL = f"""
WITH raw AS (
 SELECT entry_id, {ROLE_SQL.format("role")} AS role, lower(trim(session_tag)) AS session_tag, tool_call_id, {SEEN_SQL} AS seen,
  CASE WHEN timestamp IS NULL OR isnan(timestamp) THEN try_cast(split_part(entry_id, ':', 2) AS DOUBLE) WHEN timestamp >= 1e11 THEN timestamp / 1e3 ELSE timestamp END AS t
 FROM chat_messages WHERE session_tag IS NOT NULL
), m AS (
 SELECT entry_id, max(role) AS role, any_value(session_tag) AS session_tag, any_value(tool_call_id) AS tool_call_id, bool_or(seen) AS seen, any_value(t) AS t
 FROM raw GROUP BY entry_id
), ua AS (
 SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS before FROM m WHERE role IN ('user', 'assistant')
 WINDOW w AS (PARTITION BY session_tag ORDER BY t, CASE role WHEN 'user' THEN 1 ELSE 3 END, entry_id)
), runs AS (
 SELECT session_tag, run, any_value(role) AS role, bool_or(seen) AS seen, min(pos) AS pos FROM (
  SELECT *, sum(CASE WHEN before IS NULL OR before <> role THEN 1 ELSE 0 END) OVER (PARTITION BY session_tag ORDER BY pos) AS run FROM ua
 ) GROUP BY session_tag, run
), nexts AS (SELECT *, lead(role) OVER (PARTITION BY session_tag ORDER BY run) AS nrole, lead(seen) OVER (PARTITION BY session_tag ORDER BY run) AS nseen FROM runs
), facts AS (
 SELECT m.session_tag,
  NOT bool_or(role IN ('user', 'assistant') AND seen) IS TRUE AS is_empty,
  bool_or(role IS NULL) AS no_role,
  bool_or(role = 'tool' AND NOT EXISTS (SELECT 1 FROM m a WHERE a.session_tag = m.session_tag AND a.role = 'assistant' AND a.tool_call_id = m.tool_call_id)) AS orphan
 FROM m GROUP BY m.session_tag
), verdict AS (
 SELECT f.session_tag, CASE WHEN f.is_empty THEN 'empty'
  WHEN f.no_role OR f.orphan IS TRUE OR (SELECT r.role FROM runs r WHERE r.session_tag = f.session_tag AND r.run = 1) = 'assistant' THEN 'broken'
  WHEN EXISTS (SELECT 1 FROM nexts x WHERE x.session_tag = f.session_tag AND x.role = 'user' AND NOT coalesce(x.nrole = 'assistant' AND x.nseen, FALSE)) THEN 'missing_reply' END AS reason
 FROM facts f
) SELECT session_tag, reason FROM verdict WHERE reason IS NOT NULL
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v for k, v in globals().items() if k.startswith("p") and k[1:2].isdigit() and callable(v)}


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1_SQL,
        "p5_found": P5_SQL,
        "p6_decoded": "SELECT doc_id, coalesce(text, '') AS text FROM documents",
    }
