"""Helpers for tables of vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors without NULL or non-finite components; an empty one counts as usable."""
    return F.coalesce(
        F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False)
    )


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def lists(rows: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Rows of a matrix as an array of lists."""
    n, width = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.ListArray.from_arrays(offsets, pa.array(rows.ravel(), kind))


def pivots(vectors: DataFrame, many: int) -> dict[int, np.ndarray]:
    """For every length of vector, at most ``many`` of them as rows; the same ones in every run.

    A top-k by a hash of the id (column ``id``): ``many`` rows a length reach the driver, no more.
    """
    lengths = [r[0] for r in vectors.select(F.size("vec").alias("dim")).distinct().orderBy("dim").collect()]
    found = {}
    for dim in lengths:
        rows = (
            vectors.where(F.size("vec") == dim).orderBy(F.xxhash64("id"), "id").limit(many).select("vec").collect()
        )
        unique = np.unique(np.array([list(r[0]) for r in rows], np.float64).reshape(len(rows), dim), axis=0)
        found[dim] = unique
    return found


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances between rows."""
    squared = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))
