"""Vectors as whole numbers, and exact products of blocks of them."""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.llm.rows import quoted

#: Beyond this, a component times 1024 is no exact 64-bit number.
_LARGEST = 2.0**52


def whole_vectors(df: DataFrame, key: str, value: str) -> DataFrame:
    """``key`` and ``ints``: each component x of ``value`` as floor(1024 * x).

    A vector that is null or holds a null, NaN or infinite component is left
    out. A component of 2**52 and more is an error.
    """
    vector = F.col(quoted(value))

    def usable(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    def whole(x: Column) -> Column:
        x = x.cast("double")
        fits = F.abs(x) < _LARGEST
        return F.when(fits, F.floor(1024 * x)).otherwise(F.raise_error(F.lit("component too large")))

    return df.filter(vector.isNotNull() & F.forall(vector, usable)).select(
        F.col(quoted(key)).alias("key"), F.transform(vector, whole).alias("ints")
    )


def matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as the rows of a matrix, short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    made = np.zeros((len(sizes), width), np.int64)
    starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
    made[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - starts] = flat
    return made


def _highest(a: np.ndarray) -> int:
    return max(int(a.max(initial=0)), -int(a.min(initial=0)))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of ``a`` with those of ``b``, exactly."""
    bound = _highest(a) * _highest(b) * max(a.shape[1], 1)
    if bound < 1 << 53:  # every sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def paired_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner product of each row of ``a`` with the same row of ``b``, exactly."""
    if _highest(a) * _highest(b) * max(a.shape[1], 1) < 1 << 63:
        return (a.astype(np.int64) * b.astype(np.int64)).sum(axis=1)
    return (a.astype(object) * b.astype(object)).sum(axis=1).astype(np.int64)
