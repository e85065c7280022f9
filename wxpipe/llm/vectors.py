"""Vectors of integers, shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Squared length up to which inner products, distances and their partial sums are exact.
MOST_SQUARE = float(1 << 50)
#: One component of a vector of floats counts as floor(SCALE * x).
SCALE = 256


def whole_components(vector: str) -> Column:
    """Each component x as floor(256 * x), an array of ints; null where the row takes no part.

    That is where the vector is null or holds a null, NaN or infinite component. A vector longer
    than 2**25 (after scaling) raises: its inner products need not fit a long.
    """
    vec = F.col(f"`{vector}`")
    infinite = F.lit(float("inf"))
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    doubles = F.transform(vec, lambda x: x.cast("double"))
    square = F.aggregate(doubles, F.lit(0.0), lambda s, x: s + (x * SCALE) * (x * SCALE))
    return F.when(
        vec.isNotNull() & F.forall(doubles, sound),
        F.when(
            square <= MOST_SQUARE, F.transform(doubles, lambda x: F.floor(x * SCALE).cast("int"))
        ).otherwise(F.raise_error(F.lit("a vector is too long for exact inner products"))),
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A list column as rows of ``dims`` ints; shorter vectors end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), np.int32)
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.cumsum(sizes) - sizes
    out[row, np.arange(len(flat)) - starts[row]] = flat
    return out


def longest(df: DataFrame, vector: str) -> Column:
    """Aggregate: components of the longest vector."""
    return F.coalesce(F.max(F.size(F.col(f"`{vector}`"))), F.lit(0))
