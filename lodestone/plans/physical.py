"""Helpers that steer physical execution without changing results."""

from __future__ import annotations

import atexit
import bisect
import os
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``. Unset, it is a local folder in local mode and an error on a cluster."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return configured or current.get()
    if not configured and not sc.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = configured or os.path.join(tempfile.gettempdir(), "lodestone-checkpoints")
    sc.setCheckpointDir(folder)
    return folder


def remove_later(spark: SparkSession, path: str) -> None:
    """Delete a stage folder when the session's process ends: plans that read it may run until then."""

    def remove() -> None:
        try:
            jvm = spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass

    atexit.register(remove)


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder; survives the loss of executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write to a fresh Parquet table in the shared folder and read it back: compressed, columnar, prunable."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    remove_later(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows of a broadcast table may be this wide on average; a wider one counts as so many more rows.
BROADCAST_ROW_BYTES = 256


def bounded_broadcast(df: DataFrame, limit_rows: int) -> DataFrame:
    """Hint a broadcast only after proving that ``df`` has at most ``limit_rows`` rows of ``BROADCAST_ROW_BYTES``; else leave the
    join to Spark. The rows are written once to the shared folder and counted there, so that nothing is computed twice."""
    staged = stage_table(df)
    size = staged._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    small = int(str(size)) <= limit_rows * BROADCAST_ROW_BYTES and staged.count() <= limit_rows
    return F.broadcast(staged) if small else staged


class OrderedScan:
    """A scan over rows in a total order that no hot group can push into one task.

    Rows are dealt to partitions by ranges of ``group + order`` (bounds from a sample of ``keys``, by default the rows
    themselves), so a group of any size spreads over partitions; they are sorted there and materialised in the shared
    checkpoint folder. What a partition must know of the rows before it comes in two ways. Rows of the group whose
    first order column is within ``horizon`` of the partition's bound are sent along as context. And a state is folded:
    each partition leaves one small state of its last group, and the driver merges them in order of partition; it holds
    one bound and one state for each partition, whatever the size of the data.
    """

    SAMPLES = 60

    def __init__(self, df: DataFrame, group: str, order: list[str], horizon: float | None = None, keys: DataFrame | None = None) -> None:
        self.spark, self.group = df.sparkSession, group
        names = [group, *order]
        parts = parallelism(self.spark)
        sample = (df if keys is None else keys).select(*names)
        n = sample.count()
        share = min(1.0, self.SAMPLES * parts / max(n, 1))
        low = lambda x: float("-inf") if x is None else x
        got = sorted({(r[0], *map(low, r[1:])) for r in (sample if share == 1 else sample.sample(share, 17)).collect()})
        bounds = sorted({got[len(got) * i // parts] for i in range(1, parts)}) if len(got) > parts else got[1:]
        self.parts = len(bounds) + 1

        def targets(key: tuple) -> list[int]:
            own = bisect.bisect_right(bounds, key)
            out, k = [own], own
            if horizon is not None:
                while k < len(bounds) and bounds[k][0] == key[0] and key[1] >= bounds[k][1] - horizon:
                    k += 1
                    out.append(k)
            return out

        @F.pandas_udf("array<int>")
        def dealt(*columns: pd.Series) -> pd.Series:
            lists = [c.astype(object).where(c.notna(), float("-inf")).tolist() if i else c.tolist() for i, c in enumerate(columns)]
            return pd.Series([targets(k) for k in zip(*lists)])

        spread = df.select("*", F.posexplode(dealt(*names)).alias("_ahead", "_part"))
        self.columns = df.columns
        self.rows = materialise(spread.repartitionById(self.parts, F.col("_part")).sortWithinPartitions(*names, "_ahead"))

    def _states(self, fold: Callable, merge: Callable) -> dict[int, tuple[object, int, object]]:
        """For each partition: the group that goes on from before it, its rows before, and the state they leave."""
        group = self.group

        def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, run, whole, state = None, 0, True, None
            seen = False
            for batch in batches:
                batch = batch[batch["_ahead"] == 0]
                if not len(batch):
                    continue
                g = batch[group].to_numpy()
                at = np.flatnonzero(g[1:] != g[:-1])
                joined = seen and name == g[0]
                whole = whole and len(at) == 0 and (joined or not seen)
                start = at[-1] + 1 if len(at) else 0
                fresh = bool(len(at)) or not joined
                state, run = fold(None if fresh else state, batch.iloc[start:]), len(g) - start + (0 if fresh else run)
                name, seen = g[-1], True
            if seen:
                yield pd.DataFrame({"part": [TaskContext.get().partitionId()], "run": [int(run)], "whole": [bool(whole)], "state": [pickle.dumps((name, state))]})

        got = {r["part"]: r for r in self.rows.mapInPandas(last, "part int, run long, whole boolean, state binary").collect()}
        out: dict[int, tuple[object, int, object]] = {}
        name, run, state = None, 0, None
        for part in range(self.parts):
            out[part] = (name, run, state)
            if r := got.get(part):
                g, s = pickle.loads(r["state"])
                joined = r["whole"] and run and g == name
                state, run, name = (merge(state, s) if joined else s), r["run"] + (run if joined else 0), g
        return out

    def map(self, fn: Callable, schema: StructType | str, fold: Callable, merge: Callable) -> DataFrame:
        """``fn(rows, n, position, state)``: the rows of one batch after ``n`` rows of context, the place of each batch row in its
        group, from 1, and the state before the first of them (None where a group begins); it returns the result for the batch
        rows only, and the state after them. ``fold(state or None, rows)`` gives the state that rows of one group leave, and
        ``merge(a, b)`` that of rows one after the other. Order and partitions are kept."""
        before, group, columns, keep = self._states(fold, merge), self.group, self.columns, self._kept
        by_part = self.spark.sparkContext.broadcast(before)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            name, ahead, state = by_part.value.get(TaskContext.get().partitionId(), (None, 0, None))
            context = None
            for batch in batches:
                sent, batch = batch.loc[batch["_ahead"] > 0, columns], batch.loc[batch["_ahead"] == 0, columns]
                if len(sent):
                    context = sent if context is None else pd.concat([context, sent])
                if not len(batch):
                    continue
                g = batch[group].to_numpy()
                start = np.concatenate([[True], g[1:] != g[:-1]])
                at = np.arange(len(g))
                position = at - np.maximum.accumulate(np.where(start, at, 0)) + 1
                if name != g[0]:
                    state, ahead = None, 0
                position[: len(g) if start.sum() == 1 else np.flatnonzero(start)[1]] += ahead
                both = pd.concat([context, batch], ignore_index=True) if context is not None and len(context) else batch.reset_index(drop=True)
                result, state = fn(both, len(both) - len(batch), position, state)
                yield result
                name, ahead = g[-1], int(position[-1])
                context = keep(both)

        return self.rows.mapInPandas(run, schema)

    #: The rows of a batch and its context that later batches may look back at; none by default.
    _kept: Callable = staticmethod(lambda rows: None)

    def looking_back(self, column: str, horizon: float) -> OrderedScan:
        """Later batches see the rows of the last group within ``horizon`` of the last row's ``column``."""
        group = self.group

        def keep(rows: pd.DataFrame) -> pd.DataFrame:
            last = rows[column].iloc[-1]
            if pd.isna(last):
                return rows.iloc[:0]
            return rows[(rows[group] == rows[group].iloc[-1]) & (rows[column] >= last - horizon)]

        self._kept = keep
        return self
