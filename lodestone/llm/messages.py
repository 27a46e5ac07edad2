"""Column expressions shared by the message operators: clean roles, times, session tags, blankness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spellings of each role after lower-casing and trimming (fixed values).
ROLE_NAMES = {
    "user": ["user", "human"],
    "assistant": ["assistant", "llm", "ai", "bot"],
    "system": ["system"],
    "tool": ["tool", "function"],
}

#: Order of roles that share one time (fixed values); messages without role come last.
ROLE_ORDER = ["system", "user", "tool", "assistant"]

INVISIBLE = r"[\s\p{Z}\p{C}\u2800\u3164\u115f\u1160\uffa0]"


def trimmed(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")


def clean_role(c: Column) -> Column:
    """user, assistant, system or tool; null where the value names none."""
    low = F.lower(trimmed(c))
    out = F.lit(None).cast("string")
    for role, names in ROLE_NAMES.items():
        out = F.when(low.isin(names), F.lit(role)).otherwise(out)
    return out


def role_rank(role: Column) -> Column:
    out = F.lit(len(ROLE_ORDER))
    for i, name in enumerate(ROLE_ORDER):
        out = F.when(role == name, F.lit(i)).otherwise(out)
    return out


def clean_tag(c: Column) -> Column:
    return F.lower(trimmed(c))


def clean_time(ts: Column, entry_id: Column) -> Column:
    """Epoch seconds. Milli- and microseconds are brought to seconds; a null or NaN time is the one inside ``entry_id``."""
    inner = F.try_element_at(F.split(entry_id, ":"), F.lit(2)).try_cast("double")
    t = F.coalesce(F.nanvl(ts, F.lit(None).cast("double")), F.when(F.size(F.split(entry_id, ":")) >= 3, inner))
    return F.when(F.abs(t) >= 1e14, t / 1e6).when(F.abs(t) >= 1e11, t / 1e3).otherwise(t)


def visible(c: Column) -> Column:
    """Whether the text holds anything that can be seen; false for null."""
    return F.coalesce(F.length(F.regexp_replace(c, INVISIBLE, "")) > 0, F.lit(False))


def one_per_entry(df: DataFrame, columns: list[str], arrival: str = "ingested_at") -> DataFrame:
    """One row for each ``entry_id``: the first delivery, with the first clean role that any delivery names.

    ``df`` has entry_id, role (clean), ``arrival`` and ``columns``. Rows without entry_id are dropped. The
    aggregate combines on the map side, so a message delivered a million times reaches the reducer once
    for each map task; deliveries at one time are told apart by a hash of their columns.
    """
    tie = F.struct(F.col(arrival).isNull(), F.col(arrival), F.xxhash64(*columns))
    first = F.min_by(F.struct(*columns), tie).alias("_first")
    role = F.min_by(F.col("role"), F.struct(F.col("role").isNull(), F.col(arrival), F.col("role"))).alias("role")
    grouped = df.where(F.col("entry_id").isNotNull()).groupBy("entry_id").agg(role, first)
    return grouped.select("entry_id", "role", "_first.*")
