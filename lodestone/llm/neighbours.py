"""Problem 4: the most similar vectors of every vector.

Method: cross-polytope hashing. Pseudo-rotations made of Hadamard transforms with random signs turn each unit vector; its
code is the nearest signed axis, over several levels. Each table holds every vector under its code; a vector also probes
the second-nearest axis of each level. A bucket that is too large is split by further levels, up to ``DEPTH`` times.

``nearest`` lists the ``k`` most similar at any distance. The vectors travel with their codes, in 16 bits a number; those of a
bucket are multiplied with one another and each leaves its best. The number of tables grows with the cube root of the number of
codes, which keeps the share of true neighbours over 0.9 as tables of vectors grow; ``recall`` measures it. With
``exact=True`` all are compared with all instead, in blocks, at a cost that grows with the square of their number.

``mutual`` needs only pairs within a small distance, so that codes and 127 sign bits are all that is shuffled: vectors that
meet in a bucket are compared by the signs, and what is left is ranked by the exact distance. Where a bucket is so dense that
signs leave many candidates for each vector, exact distances are taken in place and only the ``k`` nearest of each go on, so no
bucket gives all its pairs.

Vectors that are equal bit for bit are one entry of the index with at most ``k + 1`` keys, which loses nothing: the ten most
similar of any copy are copies of least key. In ``nearest`` every copy has a list, that of its vector.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lodestone.operators.search import batch_knn
from lodestone.plans.physical import bounded_broadcast, parallelism, stage_table

#: Rows that a bucket is meant to hold; the number of axes grows with the table.
BUCKET_ROWS = 96
#: A bucket over so many rows is split by one more level of hashing, at most so many times.
HEAVY_ROWS, DEPTH = 4096, 3
#: A bucket whose signs leave more candidates than so many for each of its rows is ranked exactly where it is.
CROWDED = 32
#: Two vectors meet if their sign bits differ in at most the mean of vectors at ``max_distance`` plus so many deviations:
#: at that very distance 0.6 in 100 are lost, at half of it none.
SIGMAS = 2.5
#: A candidate is also dropped when its sign bits lie so many beyond those of the k-th best in its bucket.
SLACK_BITS = 24
SIGN_BITS = 127
#: Candidate ids up to this number are sent to all executors to filter the scan of the vectors.
BROADCAST_IDS = 1_000_000
#: Lists of large groups of copies up to this number are sent to all executors.
BROADCAST_LISTS = 50_000

#: For neighbours at any distance: rows that a bucket is meant to hold, and tables where there are 128 codes.
WIDE_ROWS, WIDE_TABLES = 2048, 7
#: Numbers of unit vectors as they travel.
SCALE = 32767

#: Vectors of a block of the exact search, and blocks that one task goes through for each of its own: with 64 floats each, 64 MB.
BLOCK_ROWS = 32768
TASK_BLOCKS = 8
#: The part of two blocks that is multiplied at once.
TILE = (512, 4096)

#: ``place`` is table and code; ``subs`` the nearest and second axes of further levels; the least bit of ``s0`` marks the
#: vector's own bucket, the other 127 bits of ``s0`` and ``s1`` are signs.
BUCKETS = "place long, subs long, vid long, s0 long, s1 long"
#: The same with the numbers of the vector in place of signs.
WIDE_BUCKETS = "place long, subs long, vid long, s0 long, v binary"


@lru_cache(maxsize=64)
def rotation(dims: int, seed: int) -> np.ndarray:
    """The matrix of three rounds of random signs and Hadamard transform, for vectors padded to a power of two."""
    size = 1 << max(1, (dims - 1).bit_length())
    h = np.ones((1, 1), "float32")
    while len(h) < size:
        h = np.block([[h, h], [h, -h]])
    h /= np.float32(size**0.5)
    rng = np.random.default_rng(seed)
    out = np.eye(size, dtype="float32")
    for _ in range(3):
        out = (out * rng.choice(np.array([-1, 1], "float32"), size)) @ h
    return np.ascontiguousarray(out[:dims])


def axes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest and the second-nearest signed axis of each row."""
    a = np.abs(y)
    at = np.arange(len(y))
    k = a.argmax(axis=1)
    first = 2 * k + (y[at, k] > 0)
    if y.shape[1] == 1:
        return first, first ^ 1
    a[at, k] = -1
    k = a.argmax(axis=1)
    return first, 2 * k + (y[at, k] > 0)


def levels(rows: int, dims: int, bucket_rows: int = BUCKET_ROWS) -> list[int]:
    """Axes of each level so that a bucket of ``rows`` vectors holds about ``bucket_rows``."""
    size = 1 << max(1, (dims - 1).bit_length())
    want, out = max(1.0, rows / bucket_rows), []
    while want >= 2 or not out:
        m = size if want >= 2 * size else 1 << max(0, int(np.log2(max(1.0, want / 2))))
        out.append(m)
        want /= 2 * m
    return out


def usable(batch: pa.RecordBatch, column: int, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows with a vector of ``dims`` finite numbers that are not all zero, and their unit vectors."""
    col = batch.column(column)
    length = np.array(col.value_lengths().fill_null(-1))
    ok = np.flatnonzero(length == dims)
    if not len(ok):
        return ok, np.zeros((0, dims), "float32")
    flat = np.asarray(col.take(pa.array(ok)).flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)).reshape(-1, dims)
    with np.errstate(all="ignore"):
        norm = np.sqrt((flat**2).sum(axis=1))
        good = np.isfinite(norm) & (norm > 0)
        unit = flat[good] / norm[good, None]
    return ok[good], unit.astype("float32")


def _hasher(dims: int, tables: int, shape: list[int], counting: bool, depth: int = 0, wide: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(64, dtype="uint64")
        place = np.cumprod([1] + [2 * m for m in shape])
        size = rotation(dims, 0).shape[1]
        for batch in batches:
            ok, unit = usable(batch, 1, dims)
            if not len(ok):
                continue
            vid = batch.column(0).to_numpy(zero_copy_only=False)[ok]
            vid, once = np.unique(vid, return_index=True)
            unit = unit[once]
            if wide and not counting:
                numbers = np.rint(unit * SCALE).astype("int16")
                last = pa.FixedSizeBinaryArray.from_buffers(pa.binary(2 * dims), len(vid), [None, pa.py_buffer(numbers.tobytes())]).cast(pa.binary())
                s0 = np.zeros(len(vid), "uint64")
            elif not counting:
                signs = np.concatenate([unit @ rotation(dims, 9000 + i) for i in range(-(-128 // size))], axis=1)[:, :128] > 0
                s0, s1 = ((signs[:, x : x + 64] * weights).sum(axis=1, dtype="uint64") for x in (0, 64))
                s0 &= ~np.uint64(1)
                last = pa.array(s1.view("int64"))
            for t in range(tables):
                pairs = [axes((unit @ rotation(dims, 100 * t + k))[:, :m]) for k, m in enumerate(shape)]
                code = t * place[-1] + sum(p[0].astype("int64") * w for p, w in zip(pairs, place))
                if counting:
                    yield pa.RecordBatch.from_arrays([pa.array(code)], names=["place"])
                    continue
                packed = np.zeros(len(vid), "int64")
                for level in range(depth):
                    first, second = axes(unit @ rotation(dims, 100 * t + 90 + level))
                    packed += (first.astype("int64") * 2 * size + second) * (4 * size * size) ** level
                subs = pa.array(packed)
                for k, c in enumerate([code] + [code + (p[1].astype("int64") - p[0]) * w for p, w in zip(pairs, place)]):
                    own = s0 | np.uint64(1) if k == 0 else s0
                    yield pa.RecordBatch.from_arrays([pa.array(c), subs, pa.array(vid), pa.array(own.view("int64")), last], names=["place", "subs", "vid", "s0", "v" if wide else "s1"])

    return run


def _meet(limit_bits: int, k: int):
    """Pairs of one bucket whose sign bits are near, or the name of the bucket where they are too many; a stream sorted by bucket, with
    the open bucket carried on."""

    def bucket(vid: np.ndarray, home: np.ndarray, s: np.ndarray) -> list[np.ndarray] | None:
        vid, home, s = _once(vid, home, s)
        base = np.flatnonzero(home)
        out, total = [], 0
        for a in range(0, len(vid), 1024):
            q = slice(a, min(len(vid), a + 1024))
            near, held = [], 0
            for b in range(0, len(base), 4096):
                j = base[b : b + 4096]
                bits = np.bitwise_count(s[q][:, None, :] ^ s[j][None, :, :]).sum(axis=2, dtype="int16")
                x, y = np.nonzero(bits <= limit_bits)
                keep = vid[q][x] != vid[j][y]
                near.append((x[keep], j[y[keep]], bits[x[keep], y[keep]]))
                held += int(keep.sum())
                if held > 4 * CROWDED * 1024:
                    return None
            x, j, bits = (np.concatenate(c) for c in zip(*near)) if near else (np.zeros(0, int),) * 3
            if len(x):
                order = np.lexsort((bits, x))
                x, j, bits = x[order], j[order], bits[order]
                start = np.searchsorted(x, x)
                nth = np.minimum(start + k - 1, np.searchsorted(x, x, side="right") - 1)
                keep = bits <= bits[nth] + SLACK_BITS
                v, w = vid[q][x[keep]], vid[j[keep]]
                out.append(np.stack([np.minimum(v, w), np.maximum(v, w)], axis=1))
                total += len(v)
                if total > CROWDED * len(vid):
                    return None
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest: pd.DataFrame | None = None

        def pairs(rows: pd.DataFrame) -> pd.DataFrame:
            code = rows["place"].to_numpy()
            edge = np.flatnonzero(code[1:] != code[:-1]) + 1
            vid = rows["vid"].to_numpy()
            s = rows[["s0", "s1"]].to_numpy().view("uint64")  # bitwise_count takes the absolute value of signed numbers
            home = (s[:, 0] & np.uint64(1)) == 1
            s[:, 0] &= ~np.uint64(1)
            out, crowded = [], []
            for a, b in zip(np.concatenate([[0], edge]), np.concatenate([edge, [len(rows)]])):
                if b - a > 1 and home[a:b].any():
                    got = bucket(vid[a:b], home[a:b], s[a:b])
                    if got is None:
                        crowded.append(int(code[a]))
                    else:
                        out += got
            got = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), "int64")
            made = pd.DataFrame({"a": got[:, 0], "b": got[:, 1], "place": pd.array([None] * len(got), "Int64")})
            extra = pd.DataFrame({"a": pd.array([None] * len(crowded), "Int64"), "b": pd.array([None] * len(crowded), "Int64"), "place": crowded})
            return pd.concat([made, extra]).astype("Int64") if crowded else made

        for rows in _whole(batches):
            yield pairs(rows)

    return run


def _once(vid: np.ndarray, home: np.ndarray, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """One row for each vector of a bucket, home before probe."""
    order = np.lexsort((~home, vid))
    first = order[np.concatenate([[True], vid[order][1:] != vid[order][:-1]])]
    return tuple(x[first] for x in (vid, home, *more))


def _whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches of whole buckets, from a stream sorted by bucket; the pieces of an open bucket are held and joined once."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        last = batch["place"].iloc[-1]
        open_ = (batch["place"] == last).to_numpy()
        if open_.all() and (not held or held[0]["place"].iloc[-1] == last):
            held.append(batch)
            continue
        yield pd.concat([*held, batch[~open_]], ignore_index=True)
        held = [batch[open_]]
    if held:
        yield pd.concat(held, ignore_index=True)


def _ranked_buckets(dims: int, k: int):
    """Of each vector of a bucket the ``k`` nearest at home in it (and what ties with the last), by exact distance."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _whole(batches):
            code = rows["place"].to_numpy()
            edge = np.flatnonzero(code[1:] != code[:-1]) + 1
            for a, b in zip(np.concatenate([[0], edge]), np.concatenate([edge, [len(rows)]])):
                unit = np.array(rows["vec"].iloc[a:b].tolist(), "float64").reshape(-1, dims)
                unit /= np.sqrt((unit**2).sum(axis=1))[:, None]
                vid, home, unit = _once(rows["vid"].to_numpy()[a:b], rows["home"].to_numpy()[a:b], unit)
                base = np.flatnonzero(home)
                if not len(base):
                    continue
                for at in range(0, len(vid), 256):
                    d = 1.0 - unit[at : at + 256] @ unit[base].T
                    d[vid[at : at + 256, None] == vid[None, base]] = np.inf
                    m = min(k, len(base))
                    bar = np.partition(d, m - 1, axis=1)[:, m - 1 : m] + 1e-12
                    x, y = np.nonzero((d <= bar) & np.isfinite(d))
                    v, w = vid[at + x], vid[base[y]]
                    yield pd.DataFrame({"a": np.minimum(v, w), "b": np.maximum(v, w)})

    return run


def placed(vectors: DataFrame, dims: int, tables: int, shape: list[int], wide: bool = False) -> DataFrame:
    """``place, vid, s0`` and ``s1`` or ``v``: every vector under the buckets that it is at home in and those that it probes; too large ones are split."""
    counted = vectors.mapInArrow(_hasher(dims, tables, shape, True), "place long").groupBy("place").count()
    most = HEAVY_ROWS * (4 if wide else 1)
    heavy = stage_table(counted.where(F.col("count") > most).select("place", F.lit(True).alias("heavy")))
    last, schema = ("v", WIDE_BUCKETS) if wide else ("s1", BUCKETS)
    columns = ["place", "vid", "s0", last]
    if heavy.isEmpty():
        return vectors.mapInArrow(_hasher(dims, tables, shape, False, 0, wide), schema).select(*columns)
    axes_ = 2 * rotation(dims, 0).shape[1]
    depth = min(DEPTH, int(62 // (2 * np.log2(axes_))))
    rows = vectors.mapInArrow(_hasher(dims, tables, shape, False, depth, wide), schema)
    for level in range(depth):
        # in a heavy bucket a row lies under its own axis of the next level and probes the second one
        own = F.floor(F.col("subs") / F.lit((axes_ * axes_) ** level * axes_)).cast("long") % axes_
        probe = F.floor(F.col("subs") / F.lit((axes_ * axes_) ** level)).cast("long") % axes_
        deep = F.array(F.struct(F.xxhash64("place", own).alias("place"), F.col("s0").alias("s0")), F.struct(F.xxhash64("place", probe).alias("place"), F.col("s0").bitwiseAND(F.lit(-2)).alias("s0")))
        flat = F.array(F.struct(F.col("place").alias("place"), F.col("s0").alias("s0")))
        rows = rows.join(bounded_broadcast(heavy, BROADCAST_IDS), "place", "left").select("vid", last, "subs", F.explode(F.when(F.col("heavy"), deep).otherwise(flat)).alias("x"))
        rows = stage_table(rows.select("x.place", "subs", "vid", "x.s0", last))
        at_home = rows.where(F.col("s0").bitwiseAND(F.lit(1)) == 1).groupBy("place").count()
        heavy = stage_table(at_home.where(F.col("count") > most).select("place", F.lit(True).alias("heavy")))
        if heavy.isEmpty():
            break
    return rows.select(*columns)


def candidates(vectors: DataFrame, rows: int, dims: int, max_distance: float, k: int, tables: int | None = None) -> DataFrame:
    """``a, b`` (a < b): ids of vectors that meet in a bucket with near sign bits, staged. ``vectors``: vid, vec."""
    shape = levels(rows, dims)
    tables = tables or max(3, len(shape) + 1)
    p = np.arccos(1 - min(max_distance, 1.0)) / np.pi
    limit = int(np.ceil(SIGN_BITS * p + SIGMAS * (SIGN_BITS * p * (1 - p)) ** 0.5))
    at = placed(vectors, dims, tables, shape)

    def together(df: DataFrame) -> DataFrame:
        return df.repartition(parallelism(vectors.sparkSession), "place").sortWithinPartitions("place")

    met = stage_table(together(at).mapInPandas(_meet(limit, k), "a long, b long, place long").distinct())
    pairs, crowded = met.where("place IS NULL").select("a", "b"), met.where("place IS NOT NULL").select("place")
    if crowded.isEmpty():
        return pairs
    dense = at.join(bounded_broadcast(crowded, BROADCAST_IDS), "place", "left_semi").select("place", "vid", (F.col("s0").bitwiseAND(F.lit(1)) == 1).alias("home"))
    once = vectors.where(is_usable("vec", dims)).dropDuplicates(["vid"])
    return stage_table(pairs.unionByName(together(dense.join(once, "vid")).mapInPandas(_ranked_buckets(dims, k), "a long, b long")).distinct())


def cosine_distance(a: str, b: str) -> Column:
    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    return 1.0 - dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def is_usable(vector: str, dims: int) -> Column:
    """Of the right length, without null, NaN and infinite numbers (NaN counts as greater than infinity), not all zero."""
    top, low = F.array_max(vector), F.array_min(vector)
    sound = (top < float("inf")) & (low > float("-inf")) & ((top != 0) | (low != 0))
    return (F.size(vector) == dims) & sound & F.forall(vector, lambda x: x.isNotNull())


BLOCKS = "block long, ids binary, numbers binary"
RANKED = "id long, near array<struct<distance: double, id: long>>"


def _blocks(dims: int):
    """Rows of id and vector as blocks of plain numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids, numbers = rows.column(0).to_numpy(), rows.column(1).combine_chunks().flatten().to_numpy()
            cells = [pa.array([int(ids[0])]), *(pa.array([x.tobytes()], pa.binary()) for x in (ids, numbers))]
            return pa.RecordBatch.from_arrays(cells, names=["block", "ids", "numbers"])

        for batch in batches:
            batch = batch.take(pa.array(usable(batch, 1, dims)[0]))
            while batch.num_rows:
                room = BLOCK_ROWS - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == BLOCK_ROWS:
                    yield block()
                    held = []
        if held:
            yield block()

    return run


class _Best:
    """The ``depth`` nearest so far of each vector of a block, by distance and then id."""

    def __init__(self, block: tuple[np.ndarray, np.ndarray], depth: int) -> None:
        self.ids, self.unit = block
        self.single = self.unit.astype("float32")
        self.depth = depth
        self.distance = np.full((len(self.ids), depth), np.inf)
        self.near = np.zeros((len(self.ids), depth), "int64")
        # products of single precision differ from exact ones by less than this
        self.slack = np.float32((self.unit.shape[1] + 8) * 2.0**-23)

    def offer(self, other: tuple[np.ndarray, np.ndarray]) -> None:
        ids, unit = other
        single = unit.astype("float32")
        for a in range(0, len(self.ids), TILE[0]):
            for b in range(0, len(ids), TILE[1]):
                score = self.single[a : a + TILE[0]] @ single[b : b + TILE[1]].T
                bar = (1.0 - self.distance[a : a + TILE[0], -1]).astype("float32") - self.slack
                if np.isinf(bar).any() and score.shape[1] > self.depth + 1:
                    # the vector itself may be among them
                    bar = np.maximum(bar, np.partition(score, -self.depth - 1, axis=1)[:, -self.depth - 1] - 2 * self.slack)
                x, y = np.divmod(np.flatnonzero(score >= bar[:, None]), score.shape[1])
                x, y = x + a, y + b
                other_one = self.ids[x] != ids[y]
                x, y = x[other_one], y[other_one]
                if len(x):
                    self._merge(x, np.maximum(1.0 - np.einsum("ij,ij->i", self.unit[x], unit[y]), 0.0), ids[y])

    def _merge(self, x: np.ndarray, distance: np.ndarray, ids: np.ndarray) -> None:
        rows = np.unique(x)
        x = np.concatenate([x, np.repeat(rows, self.depth)])
        distance = np.concatenate([distance, self.distance[rows].ravel()])
        ids = np.concatenate([ids, self.near[rows].ravel()])
        order = np.lexsort((ids, distance, x))
        nth = np.arange(len(x)) - np.searchsorted(x[order], x[order])
        order, nth = order[nth < self.depth], nth[nth < self.depth]
        self.distance[x[order], nth] = distance[order]
        self.near[x[order], nth] = ids[order]

    def result(self) -> pa.RecordBatch:
        real = np.isfinite(self.distance)
        offsets = pa.array(np.concatenate([[0], real.sum(axis=1).cumsum()]).astype("int32"))
        cells = pa.StructArray.from_arrays([pa.array(self.distance[real]), pa.array(self.near[real])], names=["distance", "id"])
        return pa.RecordBatch.from_arrays([pa.array(self.ids), pa.ListArray.from_arrays(offsets, cells)], names=["id", "near"])


def _every_pair(dims: int, depth: int, kind: str):
    def read(batch: pa.RecordBatch, row: int, first: int) -> tuple[np.ndarray, np.ndarray]:
        ids, numbers = (np.frombuffer(batch.column(first + i)[row].as_buffer(), t) for i, t in enumerate(("int64", kind)))
        x = numbers.reshape(-1, dims).astype("float64")
        return ids, x / np.sqrt((x**2).sum(axis=1))[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, best = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block = batch.column(0)[row].as_py()
                if best is None or block != open_:
                    if best is not None:
                        yield best.result()
                    open_, best = block, _Best(read(batch, row, 1), depth)
                best.offer(read(batch, row, 4))
        if best is not None:
            yield best.result()

    return run


def ranked(vectors: DataFrame, dims: int, depth: int) -> DataFrame:
    """``id, near``: the ``depth`` nearest other vectors of each, by distance and then id. ``vectors``: id, vec."""
    kind = "float64" if vectors.schema["vec"].dataType.elementType.typeName() == "double" else "float32"
    blocks = stage_table(vectors.mapInArrow(_blocks(dims), BLOCKS))
    parts = -(-blocks.count() // TASK_BLOCKS)
    other = blocks.select(*(F.col(c).alias(f"{c}_b") for c in blocks.columns)).coalesce(max(1, parts))
    best = blocks.crossJoin(other).mapInArrow(_every_pair(dims, depth, kind), RANKED)
    return best.groupBy("id").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, depth).alias("near"))


def _best_of_buckets(dims: int, depth: int):
    """Of each vector of a bucket the ``depth`` nearest that met it there: all for one at home, those at home for one that probes."""

    def nearest_of(v: np.ndarray, norm: np.ndarray, vid: np.ndarray, rows: np.ndarray, among: np.ndarray) -> pa.RecordBatch:
        own, single = v[rows], v[among].T
        best_d = np.full((len(rows), depth), np.inf)
        best_i = np.zeros((len(rows), depth), "int64")
        for a in range(0, len(rows), 256):
            some = slice(a, a + 256)
            for b in range(0, len(among), 8192):
                score = own[some] @ single[:, b : b + 8192]
                m = min(depth + 1, score.shape[1])  # the vector itself may be among them
                at = among[b + np.argpartition(-score, m - 1, axis=1)[:, :m]]
                # whole numbers, so that a pair has one distance wherever it meets
                dot = np.einsum("ij,ikj->ik", v[rows[some]].astype("float64"), v[at].astype("float64"))
                d = np.maximum(1.0 - dot / (norm[rows[some], None] * norm[at]), 0.0)
                d[vid[at] == vid[rows[some], None]] = np.inf
                d, ids = np.concatenate([best_d[some], d], axis=1), np.concatenate([best_i[some], vid[at]], axis=1)
                order = np.lexsort((ids, d), axis=1)[:, :depth]
                best_d[some], best_i[some] = np.take_along_axis(d, order, 1), np.take_along_axis(ids, order, 1)
        real = np.isfinite(best_d)
        ends = pa.array(np.concatenate([[0], real.sum(axis=1).cumsum()]).astype("int32"))
        cells = pa.StructArray.from_arrays([pa.array(best_d[real]), pa.array(best_i[real])], names=["distance", "id"])
        return pa.RecordBatch.from_arrays([pa.array(vid[rows]), pa.ListArray.from_arrays(ends, cells)], names=["id", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def ranked_(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held)
            code, vid = rows.column("place").to_numpy(), rows.column("vid").to_numpy()
            home = rows.column("s0").to_numpy() == 1
            v = np.frombuffer(b"".join(rows.column("v").to_pylist()), "int16").reshape(-1, dims).astype("float32")
            edge = np.flatnonzero(code[1:] != code[:-1]) + 1
            for a, b in zip(np.concatenate([[0], edge]), np.concatenate([edge, [len(code)]])):
                ids, at_home, x = _once(vid[a:b], home[a:b], v[a:b])
                base = np.flatnonzero(at_home)
                if len(base) and len(ids) > 1:
                    norm = np.sqrt((x.astype("float64") ** 2).sum(axis=1))
                    yield nearest_of(x, norm, ids, base, np.arange(len(ids)))
                    if len(base) < len(ids):
                        yield nearest_of(x, norm, ids, np.flatnonzero(~at_home), base)

        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            code = batch.column("place").to_numpy()
            cut = int(np.searchsorted(code == code[-1], True))
            if cut or (held and held[0].column("place")[-1].as_py() != code[0]):
                yield from ranked_([*held, batch.slice(0, cut)] if cut else held)
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from ranked_(held)

    return run


def hashed(vectors: DataFrame, dims: int, depth: int, tables: int | None = None) -> DataFrame:
    """As ``ranked``, of the vectors that meet in a bucket; distances are those of numbers in 16 bits, off by less than 0.0001."""
    shape = levels(vectors.count(), dims, WIDE_ROWS)
    tables = tables or max(4, int(np.ceil(WIDE_TABLES * (np.prod([2.0 * m for m in shape]) / 128) ** (1 / 3))))
    at = placed(vectors.select(F.col("id").alias("vid"), "vec"), dims, tables, shape, wide=True)
    met = at.repartition(parallelism(vectors.sparkSession), "place").sortWithinPartitions("place").mapInArrow(_best_of_buckets(dims, depth), RANKED)
    return met.groupBy("id").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))), 1, depth).alias("near"))


def _each_once(pairs: Column) -> Column:
    """Of sorted (distance, key) the first of each key."""
    keys = F.transform(pairs, lambda p: p["key"])
    return F.filter(pairs, lambda p, i: F.array_position(keys, p["key"]) == i + 1)


def nearest(df: DataFrame, key: str, vector: str, dims: int = 64, k: int = 10, exact: bool = False, tables: int | None = None) -> DataFrame:
    """``key, neighbour, distance, nth``: the ``k`` most similar other keys of every key, at any distance; by hashing, or exact.

    Equal distances are ordered by key. Null keys, and vectors that are null, of another length, all zero or
    hold NaN, infinite or null numbers are left out; a repeated row counts once, and of a key with several vectors the
    nearest counts. Copies of one vector are at distance 0. Other columns are ignored; an empty table
    gives no rows.
    """
    base = df.select(F.col(key).alias("key"), F.col(vector).alias("vec")).where(F.col("key").isNotNull() & is_usable("vec", dims))
    base = base.withColumn("vid", F.xxhash64("vec"))
    keyed = base.select("vid", "key")
    # a key with several vectors takes as many places in a list
    several = keyed.groupBy("key").agg(F.count_distinct("vid").alias("n")).agg(F.max("n")).head()[0] or 1
    # the k + 1 least keys of each vector: no copy beyond them is among the k most similar of anything
    least = keyed.withColumn("nth", F.dense_rank().over(Window.partitionBy("vid").orderBy("key"))).where(F.col("nth") <= k + 1)
    groups = least.groupBy("vid").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    # ids in the order of the least key, which decides between vectors at equal distances
    groups = groups.withColumn("first", F.col("keys")[0]).repartitionByRange(parallelism(df.sparkSession), "first").sortWithinPartitions("first")
    groups = stage_table(groups.select(F.monotonically_increasing_id().alias("id"), "vid", "keys"))
    vectors = base.select("vid", "vec").dropDuplicates(["vid"]).join(groups.select("vid", "id"), "vid").select("id", "vec")
    depth = (k + 1) * several - 1
    near = ranked(vectors, dims, depth) if exact else hashed(stage_table(vectors), dims, depth, tables)
    arcs = near.select("id", F.explode("near").alias("n")).select("id", F.col("n.id").alias("other"), F.col("n.distance").alias("distance"))
    offered = arcs.join(groups.select(F.col("id").alias("other"), F.slice("keys", 1, k).alias("keys")), "other").select("id", "distance", "keys", F.lit(None).cast("long").alias("vid"))
    offered = offered.unionByName(groups.select("id", F.lit(0.0).alias("distance"), "keys", "vid"))
    offered = offered.withColumn("pairs", F.transform("keys", lambda y: F.struct("distance", y.alias("key"))))
    own = F.first(F.when(F.col("vid").isNotNull(), F.col("keys")), ignorenulls=True)
    lists = offered.groupBy("id").agg(F.max("vid").alias("vid"), own.alias("keys"), F.array_sort(F.flatten(F.collect_list("pairs"))).alias("pairs"))
    lists = lists.withColumn("pairs", F.slice(_each_once(F.col("pairs")) if several > 1 else F.col("pairs"), 1, k + 1))
    large = groups.where(F.size("keys") > k).select("vid", F.col("keys")[k].alias("last"))
    if large.isEmpty():
        each = lists.select(F.explode("keys").alias("key"), "pairs")
    else:
        # the keys beyond the k + 1 least are nobody's neighbours, but have the list of their vector as well
        lists = stage_table(lists)
        beyond = keyed.join(bounded_broadcast(large, BROADCAST_IDS), "vid").where(F.col("key") > F.col("last")).select("vid", "key").distinct()
        shared = bounded_broadcast(lists.join(large.select("vid"), "vid", "left_semi").select("vid", "pairs"), BROADCAST_LISTS)
        each = lists.select(F.explode("keys").alias("key"), "pairs").unionByName(beyond.join(shared, "vid").select("key", "pairs"))
    if several > 1:
        each = each.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("pairs"))).alias("pairs")).withColumn("pairs", _each_once(F.col("pairs")))
    others = F.slice(F.filter("pairs", lambda p: p["key"] != F.col("key")), 1, k)
    return each.select("key", F.posexplode(others).alias("at", "p")).select("key", F.col("p.key").alias("neighbour"), F.col("p.distance").alias("distance"), (F.col("at") + 1).alias("nth"))


def close(df: DataFrame, key: str, vector: str, dims: int = 64, k: int = 10, max_distance: float = 0.09, tables: int | None = None) -> DataFrame:
    """As ``nearest``, by hashing, of what lies within ``max_distance``: for ``mutual``, so of equal vectors only
    the ``k + 1`` least keys have rows; no other copy is in a mutual pair."""
    rows = df.count()
    base = df.select(F.col(key).alias("key"), F.col(vector).alias("vec")).where(F.col("key").isNotNull() & (F.size("vec") == dims))
    base = base.withColumn("vid", F.xxhash64("vec"))
    pairs = candidates(base.select("vid", "vec"), rows, dims, max_distance, k, tables)
    ids = bounded_broadcast(pairs.select(F.explode(F.array("a", "b")).alias("vid")).distinct(), BROADCAST_IDS)
    vecs = base.join(ids, "vid", "left_semi").select("vid", "vec").dropDuplicates(["vid"])
    near = pairs.join(vecs.select(F.col("vid").alias("a"), F.col("vec").alias("va")), "a").join(vecs.select(F.col("vid").alias("b"), F.col("vec").alias("vb")), "b")
    near = near.select("a", "b", F.greatest(cosine_distance("va", "vb"), F.lit(0.0)).alias("distance")).where(F.col("distance") <= max_distance)
    # the k + 1 least keys of each vector: no copy beyond them is among the k most similar of anything
    keyed = base.where(is_usable("vec", dims)).select("vid", "key")
    keyed = keyed.withColumn("nth", F.dense_rank().over(Window.partitionBy("vid").orderBy("key"))).where(F.col("nth") <= k + 1)
    groups = keyed.groupBy("vid").agg(F.sort_array(F.collect_set("key")).alias("keys"))
    used = groups.join(ids.withColumn("used", F.lit(True)), "vid", "left").where(F.col("used") | (F.size("keys") > 1))
    groups = stage_table(used.select("vid", "keys"))
    a, b = groups.select(F.col("vid").alias("a"), F.col("keys").alias("ka")), groups.select(F.col("vid").alias("b"), F.col("keys").alias("kb"))
    across = near.join(a, "a").join(b, "b").select(F.explode("ka").alias("x"), "kb", "distance").select("x", F.explode("kb").alias("y"), "distance")
    within = groups.where(F.size("keys") > 1).select(F.explode("keys").alias("x"), "keys").select("x", F.explode("keys").alias("y"), F.lit(0.0).alias("distance"))
    both_ways = across.unionByName(across.select(F.col("y").alias("x"), F.col("x").alias("y"), "distance")).unionByName(within).where(F.col("x") != F.col("y"))
    directed = stage_table(both_ways.groupBy("x", "y").agg(F.min("distance").alias("distance")))
    best = directed.withColumn("nth", F.row_number().over(Window.partitionBy("x").orderBy("distance", "y"))).where(F.col("nth") <= k)
    return best.select(F.col("x").alias("key"), F.col("y").alias("neighbour"), "distance", "nth")


def mutual(df: DataFrame, key: str, vector: str, dims: int = 64, k: int = 10, max_distance: float = 0.09, tables: int | None = None) -> DataFrame:
    """``key_a, key_b, distance`` of keys within ``max_distance`` that are among the ``k`` most similar of each other; else as ``nearest``."""
    best = close(df, key, vector, dims, k, max_distance, tables)
    both = best.groupBy(F.least("key", "neighbour").alias("key_a"), F.greatest("key", "neighbour").alias("key_b")).agg(F.count("*").alias("n"), F.min("distance").alias("distance"))
    return both.where(F.col("n") == 2).select("key_a", "key_b", "distance")


def recall(df: DataFrame, key: str, vector: str, dims: int = 64, k: int = 10) -> DataFrame:
    """``asked, recall``: of the keys whose hash is divisible by 50, the share of their ``k`` true neighbours, found by comparing them
    with all rows, that ``nearest`` lists."""
    base = df.select(F.col(key).alias("key"), F.col(vector).alias("vec")).where(F.col("key").isNotNull() & is_usable("vec", dims)).dropDuplicates(["key"])
    ask = base.where(F.pmod(F.xxhash64("key"), F.lit(50)) == 0)
    # one more, since each is its own nearest
    true = batch_knn(base, "key", "vec", ask, "key", "vec", dims, k + 1).where("query_id <> key")
    true = true.withColumn("nth", F.row_number().over(Window.partitionBy("query_id").orderBy("rank"))).where(F.col("nth") <= k).select(F.col("query_id").alias("key"), F.col("key").alias("neighbour"))
    hit = nearest(df, key, vector, dims, k).select("key", "neighbour", F.lit(1).alias("hit"))
    return true.join(hit, ["key", "neighbour"], "left").agg(F.count_distinct("key").alias("asked"), (F.sum(F.coalesce("hit", F.lit(0))) / F.count("*")).alias("recall"))


def found(chat: DataFrame, sentences: DataFrame) -> DataFrame:
    parts = [("chat_messages", mutual(chat, "entry_id", "vector_field")), ("sentence_vectors", mutual(sentences, "record_key", "embedding"))]
    return parts[0][1].select(F.lit(parts[0][0]).alias("table_name"), "key_a", "key_b").unionByName(parts[1][1].select(F.lit(parts[1][0]).alias("table_name"), "key_a", "key_b"))
