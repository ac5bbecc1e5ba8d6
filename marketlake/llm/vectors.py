"""Vectors as whole numbers: which rows have one, and its components in numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A component x counts as floor(SCALE * x), within ±LIMIT: beyond that, sums of products would not fit in 64 bits.
SCALE, LIMIT = 256, 1 << 24


def usable(column: str) -> Column:
    """Whether the vector is there and all its components are finite numbers."""
    finite = lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    return F.col(column).isNotNull() & F.forall(column, finite)


def whole(column: pa.ListArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Usable vectors of a batch → (their rows, components as int32), once for each length of vector."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    ends = column.offsets.to_numpy()
    lengths = np.diff(ends)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        values = np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int32)
    out = []
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        out.append((rows, values[ends[rows][:, None] + np.arange(length)]))
    return out


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of two matrices of whole numbers, as int64, exact."""
    size = lambda m: float(np.sqrt((m.astype(np.float64) ** 2).sum(axis=1).max(initial=0)))
    most = size(a) * size(b)  # no sum of some of the products is greater
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 52:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T
