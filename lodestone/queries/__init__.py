"""Registered queries over the dataset tables, one or more for each operator, with the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _all() -> dict[str, tuple[Query, str | None]]:
    from lodestone.queries import filtering, platform, searching, sqldialect, upkeep

    out: dict[str, tuple[Query, str | None]] = {}
    for module in (filtering, searching, sqldialect, platform, upkeep):
        out.update(module.QUERIES)
    return out


def queries() -> dict[str, Query]:
    return {k: v[0] for k, v in _all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _all().items() if v[1] is not None}
