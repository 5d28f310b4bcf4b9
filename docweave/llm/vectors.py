"""Integer vectors from array columns, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Largest magnitude of an integer component: squares of differences of 64 such components still sum up within a long.
LIMIT = 1 << 27


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values, offsets (one more than rows) and which rows are lists, of an Arrow list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = np.asarray(column.offsets).astype(np.int64)
    return column.values.to_numpy(zero_copy_only=False), off, np.asarray(column.is_valid())


def integers(column: pa.Array, scale: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """floor(scale * x) of all components as longs, their offsets, and which rows are whole.

    A null list, or one with a null or non-finite component, isn't whole; its components are 0. A component of more than
    LIMIT fails the task: longer sums wouldn't be exact.
    """
    values, off, whole = rows_of(column)
    x = np.floor(values.astype(np.float64) * scale)
    odd = np.flatnonzero(~np.isfinite(x))
    whole = whole.copy()
    if len(odd):
        at = np.searchsorted(off, odd, side="right") - 1
        inside = (at >= 0) & (at < len(whole))
        whole[at[inside]] = False
        x[odd] = 0
    used = x[off[0]:off[-1]] if len(off) else x[:0]
    if len(used) and np.abs(used).max() > LIMIT:
        raise ValueError(f"a component of more than {LIMIT // scale} in magnitude")
    return x.astype(np.int64), off, whole


def lists(matrix: np.ndarray, kind=np.int32) -> pa.Array:
    """The rows of a matrix as a list column."""
    n, dims = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * dims + 1, dims or 1, dtype=np.int32) if dims else np.zeros(n + 1, np.int32)),
                                    pa.array(np.ascontiguousarray(matrix, kind).reshape(-1)))
