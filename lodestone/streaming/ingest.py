"""Streaming ingest: deduplicated upserts, windowed counts of late data, scoring of micro-batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def deduplicated(stream: DataFrame, key: str, event_time: str, lateness: str = "1 hour") -> DataFrame:
    """Each key once within the watermark; state older than ``lateness`` is dropped, so it stays bounded."""
    return stream.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, event_time: str, window: str, lateness: str, by: list[str], slide: str | None = None) -> DataFrame:
    """Rows for each window and group; late rows count until the watermark has passed their window."""
    w = F.window(event_time, window, slide) if slide else F.window(event_time, window)
    return stream.withWatermark(event_time, lateness).groupBy(w.alias("window"), *by).agg(F.count("*").alias("n"))


def session_counts(stream: DataFrame, event_time: str, gap: str, lateness: str, by: list[str]) -> DataFrame:
    return stream.withWatermark(event_time, lateness).groupBy(F.session_window(event_time, gap).alias("window"), *by).agg(F.count("*").alias("n"))


def upsert_into(index, stream: DataFrame, checkpoint: str, trigger_once: bool = True):
    """Loads each micro-batch into an index. A batch that is delivered again replaces its own keys, so the result is exactly once."""

    def load(batch: DataFrame, _: int) -> None:
        if not batch.isEmpty():
            index.load(batch.dropDuplicates([index.key]))

    writer = stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger_once else writer).start()


def score_into(stream: DataFrame, score: Callable[[DataFrame], DataFrame], sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs a batch query (a router, a nearest-neighbour search) on each micro-batch."""
    return stream.writeStream.foreachBatch(lambda b, i: sink(score(b), i)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
