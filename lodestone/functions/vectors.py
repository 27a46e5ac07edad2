"""Vector expressions that stay inside generated code, distance normalisation and quantisation."""

from __future__ import annotations

import math
import warnings
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Up to so many dimensions a product is unrolled into one generated expression; more would pass the 64 KB that a Java method
#: may have, so beyond a higher-order function is used.
UNROLL = 16


def _terms(c: Column, v: list[float], term) -> Column:
    return reduce(lambda a, b: a + b, [term(F.get(c, F.lit(i)).cast("double"), float(x)) for i, x in enumerate(v)])


def dot(c: Column, v: list[float]) -> Column:
    """Dot product with a constant vector; null where the column's length differs or an element is null."""
    if len(v) <= UNROLL:
        out = _terms(c, v, lambda x, y: x * F.lit(y))
    else:
        other = F.array(*[F.lit(float(x)) for x in v])
        out = F.aggregate(F.zip_with(c, other, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(c) == len(v), out)


def squared_norm(c: Column, dims: int) -> Column:
    if dims <= UNROLL:
        parts = [F.get(c, F.lit(i)).cast("double") for i in range(dims)]
        return reduce(lambda a, b: a + b, [x * x for x in parts])
    return F.aggregate(F.transform(c, lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda a, x: a + x)


def cosine_distance(c: Column, v: list[float]) -> Column:
    """1 - cosine; null where either vector has norm zero."""
    norm = math.sqrt(sum(float(x) ** 2 for x in v))
    own = F.sqrt(squared_norm(c, len(v)))
    return F.when(own > 0, 1.0 - dot(c, v) / (own * F.lit(norm))) if norm > 0 else F.lit(None).cast("double")


def l2_distance(c: Column, v: list[float], squared: bool = False) -> Column:
    if len(v) <= UNROLL:
        total = _terms(c, v, lambda x, y: (x - F.lit(y)) * (x - F.lit(y)))
    else:
        other = F.array(*[F.lit(float(x)) for x in v])
        total = F.aggregate(F.zip_with(c, other, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda a, x: a + x)
    total = F.when(F.size(c) == len(v), total)
    return total if squared else F.sqrt(total)


def ip_distance(c: Column, v: list[float]) -> Column:
    return 1.0 - dot(c, v)


def distance(metric: str, c: Column, v: list[float]) -> Column:
    return {"cosine": cosine_distance, "l2": l2_distance, "ip": ip_distance}[metric.lower()](c, v)


def norm_cosine(d: Column) -> Column:
    return F.greatest((2.0 - d) / 2.0, F.lit(0.0))


def denorm_cosine(similarity: float) -> float:
    return max(2.0 - 2.0 * similarity, 0.0)


def norm_l2(d: Column) -> Column:
    return 1.0 / (1.0 + d)


def normalised(metric: str, d: Column) -> Column:
    """Similarity of a distance; inner products have none and come back as they are, with a warning."""
    if metric.lower() == "cosine":
        return norm_cosine(d)
    if metric.lower() == "l2":
        return norm_l2(d)
    warnings.warn("inner-product distances cannot be normalised", UserWarning, stacklevel=2)
    return d


def quantise(c: Column, to: str) -> Column:
    """Minimum-maximum scaling of each vector to int8 or uint8 with half-even rounding; a constant vector becomes the midpoint."""
    low, span = (-128, 255) if to == "int8" else (0, 255)
    mid = 0 if to == "int8" else 128
    lo, hi = F.array_min(c).cast("double"), F.array_max(c).cast("double")
    return F.transform(c, lambda x: F.when(hi > lo, F.bround((x.cast("double") - lo) / (hi - lo) * span) + low).otherwise(F.lit(mid)).cast("int"))


def to_bytes(v, datatype: str) -> bytes:
    """The stored form of a vector: little-endian numbers; bfloat16 keeps the upper 16 bits of float32."""
    a = np.asarray(v)
    if datatype == "bfloat16":
        return (a.astype("<f4").view("<u4") >> 16).astype("<u2").tobytes()
    kinds = {"float16": "<f2", "float32": "<f4", "float64": "<f8", "int8": "i1", "uint8": "u1"}
    return a.astype(kinds[datatype]).tobytes()


def from_bytes(b: bytes, datatype: str) -> list[float]:
    if datatype == "bfloat16":
        return (np.frombuffer(b, "<u2").astype("<u4") << 16).view("<f4").astype(float).tolist()
    kinds = {"float16": "<f2", "float32": "<f4", "float64": "<f8", "int8": "i1", "uint8": "u1"}
    return np.frombuffer(b, kinds[datatype]).astype(float).tolist()


def datatype_of(n_bytes: int, dims: int) -> list[str]:
    """Element types whose vectors of ``dims`` have so many bytes."""
    return {8: ["float64"], 4: ["float32"], 2: ["float16", "bfloat16"], 1: ["int8", "uint8"]}.get(n_bytes // dims if n_bytes % dims == 0 else 0, [])


def convert(df: DataFrame, column: str, source: str, target: str) -> DataFrame:
    """Binary vectors of one element type to another, in Arrow batches; integers are scaled as in ``quantise``."""
    @F.pandas_udf("binary")
    def run(s: pd.Series) -> pd.Series:
        def one(b):
            if b is None:
                return None
            v = np.array(from_bytes(b, source))
            if target in ("int8", "uint8") and source not in ("int8", "uint8"):
                low, mid = (-128, 0) if target == "int8" else (0, 128)
                lo, hi = v.min(), v.max()
                v = np.round((v - lo) / (hi - lo) * 255) + low if hi > lo else np.full(len(v), mid)
            return to_bytes(v, target)

        return s.map(one)

    return df.withColumn(column, run(column))
