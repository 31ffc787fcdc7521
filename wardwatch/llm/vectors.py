"""Vectors in Arrow columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(column: str) -> Column:
    """The vector is there, not empty, and every component is a finite number."""
    v = F.col(column)
    return F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf")))
                                                 & ~F.isnan(x)), F.lit(False))


def by_width(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column grouped by length: (row numbers, matrix in doubles)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    at = column.offsets.to_numpy()
    at, size = at[:-1] - at[0], np.diff(at)
    out = []
    for width in np.unique(size):
        rows = np.flatnonzero(size == width)
        out.append((rows, flat[at[rows][:, None] + np.arange(width)]))
    return out


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in doubles (first by their largest component, so
    that nothing overflows)."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
