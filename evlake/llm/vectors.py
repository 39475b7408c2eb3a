"""Columns of vectors as numpy arrays."""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def lists_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All components as doubles (null: not a number), where each list starts and ends
    in them, with the end of the last, and which lists are there."""
    there = np.asarray(column.is_valid())
    length = np.asarray(pc.list_value_length(column).fill_null(0)).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).astype(np.float64)
    return values, np.concatenate(([0], np.cumsum(length))), there


def whole_vectors(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vectors have ``width`` components, all finite, and those vectors
    as a matrix."""
    values, ends, there = lists_of(column)
    rows = np.flatnonzero(there & (np.diff(ends) == width))
    matrix = values[ends[rows][:, None] + np.arange(width)] if len(rows) else np.zeros((0, width))
    finite = np.isfinite(matrix).all(1)
    return rows[finite], matrix[finite]
