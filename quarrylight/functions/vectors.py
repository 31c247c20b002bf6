"""Dense vector columns: Arrow-batched matrix arithmetic and array helpers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .batches import add_columns

# Similarities that agree to this many decimals count as equal, so that ties are
# settled by id or arrival and not by the order in which a sum was added up.
SIMILARITY_DIGITS = 10

VECTOR = T.ArrayType(T.DoubleType())


def as_vector(col: Column | str) -> Column:
    """Cast any numeric array to doubles."""
    return F.col(col).cast(VECTOR) if isinstance(col, str) else col.cast(VECTOR)


def to_matrix(column: pa.Array) -> np.ndarray:
    """An Arrow list column of equally long vectors as an (n, d) matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        raise ValueError("vector column holds nulls")
    n = len(column)
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if n == 0:
        return flat.reshape(0, 0)
    if flat.size % n:
        raise ValueError("vectors differ in length")
    return flat.reshape(n, flat.size // n)


def from_matrix(matrix: np.ndarray) -> pa.Array:
    """The reverse of :func:`to_matrix`."""
    n, d = matrix.shape
    offsets = np.arange(0, n * d + 1, d, dtype=np.int32) if d else np.zeros(n + 1, dtype=np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(matrix).ravel()))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    norms[norms == 0.0] = 1.0
    return matrix / norms


def pair_distances(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Euclidean distances between all rows of two matrices.

    From one matrix product, in one array of the size of the result; distances so small
    beside the rows that it loses their digits are computed from the differences.
    """
    left_squares, right_squares = (left * left).sum(axis=1), (right * right).sum(axis=1)
    squares = left @ (-2.0 * right.T)
    squares += left_squares[:, None]
    squares += right_squares[None, :]
    # the largest rows tell which pairs to look at, their own sizes which are too close
    least = 1e-6 * (left_squares.max(initial=0.0) + right_squares.max(initial=0.0))
    a, b = np.divmod(np.flatnonzero(squares < least), max(1, len(right)))
    close = squares[a, b] < 1e-6 * (left_squares[a] + right_squares[b])
    a, b = a[close], b[close]
    squares[a, b] = ((left[a] - right[b]) ** 2).sum(axis=1)
    return np.sqrt(squares, out=squares)


def l2_normalise(df: DataFrame, vector: str = "vector", out: str = "vector") -> DataFrame:
    """Scale vectors to length one; the zero vector stays zero."""
    return add_columns(
        df,
        [vector],
        [T.StructField(out, VECTOR)],
        lambda v: [from_matrix(unit_rows(to_matrix(v)))],
    )


def affine(
    df: DataFrame,
    matrix: np.ndarray,
    shift: np.ndarray | None = None,
    vector: str = "vector",
    out: str = "vector",
) -> DataFrame:
    """Set ``out`` to ``(v - shift) · matrix`` for a small, driver-known matrix."""

    def apply(v: pa.Array) -> list[pa.Array]:
        rows = to_matrix(v)
        return [from_matrix((rows if shift is None else rows - shift) @ matrix)]

    return add_columns(df, [vector], [T.StructField(out, VECTOR)], apply)


def argmax(values: Column) -> Column:
    """Zero-based position of the largest entry, the lowest one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def second_largest(values: Column) -> Column:
    """Second largest entry, null for a single one."""
    return F.get(F.sort_array(values, asc=False), 1)
