"""Integer views of vector columns, shared by the vector operators."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vec: str) -> Column:
    """True for vectors that are not null and hold neither null nor non-finite components."""
    # a float or double is finite exactly if x - x is 0 (NaN and infinities give NaN)
    return F.coalesce(F.forall(vec, lambda x: F.coalesce(x.cast("double") - x.cast("double") == 0.0, F.lit(False))), F.lit(False))


def floors(vectors: pa.Array, width: int, scale: int, limit: int) -> np.ndarray:
    """``floor(scale * x)`` of every component as an n x width integer matrix; shorter vectors
    are filled up with zeros. ``scale`` is a power of two, so the product is exact in double
    precision. Values of ``limit`` or more raise: sums of their squares might not fit 64 bits."""
    off = np.asarray(vectors.offsets, dtype=np.int64)
    flat = np.floor(np.asarray(vectors.flatten(), dtype=np.float64) * scale)
    if len(flat) and np.abs(flat).max() >= limit:
        raise OverflowError(f"a component times {scale} is {np.abs(flat).max():.4g}; exact 64-bit distances need less than {limit}")
    n, lengths = len(vectors), np.diff(off)
    if (lengths == width).all():
        return flat.astype(np.int64).reshape(n, width)
    out = np.zeros((n, width), np.int64)
    rows = np.repeat(np.arange(n), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(off[:-1] - off[0], lengths)] = flat.astype(np.int64)
    return out


def summed(partial: DataFrame, keys: list[str], width: int) -> list:
    """Totals of per-task partial sums ``(keys, n, s array)``: one row per key, componentwise."""
    return (partial.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i]).alias(f"s{i}") for i in range(width)])
            .collect())


def digest(numbers: np.ndarray) -> str:
    """Lowercase-hex SHA-256 of decimal integers joined by commas, in array order."""
    return hashlib.sha256(",".join(map(str, numbers.ravel().tolist())).encode()).hexdigest()
