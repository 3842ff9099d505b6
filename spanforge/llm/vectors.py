"""Integer vectors: which rows can be used, components as integers, and Arrow lists as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """Whether the vector is there and holds neither null nor non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.coalesce(F.forall(F.col(vector).cast("array<double>"), finite), F.lit(False))


def integers(vector: str, scale: int, clamp: int) -> Column:
    """Components as floor(scale * x), held within -clamp..clamp, as array<int>."""
    whole = lambda x: F.greatest(F.lit(-clamp), F.least(F.lit(clamp), F.floor(x * F.lit(float(scale)))))
    return F.transform(F.col(vector).cast("array<double>"), lambda x: whole(x).cast("int"))


def squared_norm(vector: str) -> Column:
    return F.aggregate(vector, F.lit(0).cast("long"), lambda total, x: total + x.cast("long") * x.cast("long"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column as an int64 matrix; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not len(column):
        return np.zeros((0, width), np.int64)
    values, sizes = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), column.value_lengths().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    within = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(np.arange(len(column)), sizes), within] = values
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two integer matrices: in floating point where every sum stays below 2**53."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T
