"""Problem 7: filling fixed-capacity containers with texts.

Method: hierarchical multi-length packing. Each text goes to the tier of the least capacity that holds
it; a text over the largest capacity fills whole containers and its rest is routed by size. Long
containers are packed first, their gaps are filled from the shorter tiers, and containers of a tier are
dealt to step groups of even load.

Texts are dealt by hash to shards of bounded size, and each shard is packed by itself, so the work grows
in proportion and a shard leaves at most one part-filled container for each tier.
"""

from __future__ import annotations

import bisect
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import tokens
from lodestone.plans.physical import stage_table

#: A shard holds about so many tokens and rows.
SHARD_TOKENS, SHARD_ROWS = 4_000_000, 50_000
#: Containers that are consumed together in one training step.
STEP = 8

PLACED = "capacity int, container string, step_group int, doc_id long, piece_no int, token_start long, n_tokens int, slot_start int"


class Bins:
    """Open containers of one capacity, found by the least gap that holds an item (best fit)."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.items: list[list[int]] = []
        self.load: list[int] = []
        self.gaps: list[tuple[int, int]] = []

    def place(self, item: int, size: int, new: bool) -> bool:
        i = bisect.bisect_left(self.gaps, (size, -1))
        if i < len(self.gaps):
            gap, b = self.gaps.pop(i)
        elif new:
            b, gap = len(self.items), self.capacity
            self.items.append([])
            self.load.append(0)
        else:
            return False
        self.items[b].append(item)
        self.load[b] += size
        if gap - size > 0:
            bisect.insort(self.gaps, (gap - size, b))
        return True


def pack(sizes: np.ndarray, capacities: list[int]) -> dict[int, Bins]:
    """Places every item (of size at most the largest capacity). Larger tiers first; their gaps take items of smaller tiers."""
    caps = sorted(capacities)
    order = np.argsort(-sizes, kind="stable")
    tier = np.searchsorted(caps, sizes)
    waiting = {k: [int(i) for i in order if tier[i] == k] for k in range(len(caps))}
    out: dict[int, Bins] = {}
    for k in range(len(caps) - 1, -1, -1):
        bins = out[caps[k]] = Bins(caps[k])
        for i in waiting[k]:
            bins.place(i, int(sizes[i]), new=True)
        for lower in range(k - 1, -1, -1):
            waiting[lower] = [i for i in waiting[lower] if not bins.place(i, int(sizes[i]), new=False)]
    return out


def _shard(capacities: list[int], step: int, shards: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard, only = key
        rows = rows.sort_values(["n_tokens", "doc_id", "piece_no", "copy_no"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        size, out = rows["n_tokens"].to_numpy("int64"), []
        for capacity, bins in pack(size, [only] if only else capacities).items():
            heavy = np.argsort([-x for x in bins.load], kind="stable")
            groups = max(1, math.ceil(len(heavy) / step))
            group = {}
            for nth, b in enumerate(heavy):
                lap, at = divmod(nth, groups)
                group[int(b)] = at if lap % 2 == 0 else groups - 1 - at
            if not bins.items:
                continue
            at, held = np.concatenate([np.array(x, int) for x in bins.items]), np.array([len(x) for x in bins.items])
            bin_of, ends = np.repeat(np.arange(len(held)), held), np.cumsum(size[at])
            first = np.cumsum(held) - held
            base = (ends - size[at])[first]
            out.append(pd.DataFrame({
                "capacity": capacity, "container": np.array([f"{capacity}-{shard}-{b}" for b in range(len(held))], object)[bin_of],
                "step_group": np.array([group[b] * shards + shard for b in range(len(held))])[bin_of], "doc_id": rows["doc_id"].to_numpy()[at], "piece_no": rows["piece_no"].to_numpy()[at],
                "token_start": rows["token_start"].to_numpy()[at], "n_tokens": size[at], "slot_start": ends - size[at] - np.repeat(base, held),
            }))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(columns=[x.split()[0] for x in PLACED.split(", ")])

    return run


def packed(docs: DataFrame, limits: DataFrame, each: bool = False, folder: str | None = None, step: int = STEP) -> DataFrame:
    """Every text (or piece of a text over the capacity) in its container; columns as in ``PLACED``.

    Input: doc_id, text; limits: scope ``documents.*`` and max_size in tokens. By default the capacities are tiers of
    one packing; with ``each`` the whole corpus is packed once for each capacity alone. Null and empty texts
    have size 0 and lie in a container of the least capacity. A repeated row is placed again for each repetition; a null
    doc_id is kept. Without capacities the result is an error; without texts it is empty.

    A step group holds at most ``step`` containers of one capacity and one shard, and load is evened out over the groups
    of a shard; ids of groups are unique over shards, with gaps.
    """
    found = limits.where(F.col("scope").startswith("documents.") & F.col("max_size").isNotNull()).select("max_size").distinct().limit(1001).collect()
    caps = sorted(int(r[0]) for r in found)
    if not caps or caps[0] < 1 or len(caps) > 1000:
        raise ValueError("between 1 and 1000 positive capacities of documents.* are needed")
    sizes = stage_table(tokens.count(docs, folder=folder))
    total = sizes.agg(F.sum("n_tokens"), F.count("*")).first()
    sizes = sizes.withColumn("copy_no", F.monotonically_increasing_id())
    sizes = sizes.withColumn("only", F.explode(F.array(*[F.lit(c) for c in caps])) if each else F.lit(0))
    top = F.when(F.col("only") > 0, F.col("only")).otherwise(F.lit(caps[-1]))
    starts = F.when(F.col("n_tokens") > 0, F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, top.cast("long"))).otherwise(F.array(F.lit(0).cast("long")))
    cut = sizes.select("doc_id", "copy_no", "only", "n_tokens", top.alias("top"), F.posexplode(starts).alias("piece", "token_start"))
    items = cut.select(
        "doc_id", "copy_no", "only", (F.col("piece") + 1).alias("piece_no"), "token_start",
        F.least(F.col("n_tokens") - F.col("token_start"), F.col("top").cast("long")).cast("int").alias("n_tokens"),
    )
    shards = max(1, math.ceil((total[0] or 0) / SHARD_TOKENS), math.ceil((total[1] or 0) / SHARD_ROWS))
    dealt = items.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece_no", "copy_no", "n_tokens"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard", "only").applyInPandas(_shard(caps, step, shards), PLACED)


def fill(placed: DataFrame) -> DataFrame:
    """For each capacity: containers, tokens and the share of room left unused."""
    by = placed.groupBy("capacity", "container").agg(F.sum("n_tokens").alias("load"))
    return by.groupBy("capacity").agg(
        F.count("*").alias("containers"), F.sum("load").alias("tokens"), F.round(1 - F.sum("load") / (F.count("*") * F.col("capacity")), 6).alias("unused")
    )
