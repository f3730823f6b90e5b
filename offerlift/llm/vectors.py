"""Vectors of whole numbers, and matrices of them inside tasks."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of candidates and of queries that are scored against each other at once.
ROWS, COLUMNS = 2048, 512
#: Queries that one pass over the table answers; only so many are ever sent to tasks.
BLOCK = 8192
#: Whole numbers up to here are exact as doubles.
_EXACT = 2.0**53


def whole_vectors(
    rows: DataFrame, key: str, vector: str, scale: int, also: dict[str, Column] | None = None
) -> DataFrame:
    """``key, v`` and the columns of ``also``; ``v`` holds ``floor(scale * x)`` as longs.

    Rows without a key or a vector and rows with a null or non-finite component
    are left out. Column names of ``rows`` never clash with those made here.
    """
    made = rows.select(
        F.col(f"`{key}`").alias("key"),
        F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double")).alias("v"),
        *[c.alias(name) for name, c in (also or {}).items()],
    )
    infinite = F.lit(float("inf"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite))
    made = made.where(F.col("key").isNotNull() & F.coalesce(good, F.lit(False)))
    return made.withColumn("v", F.transform("v", lambda x: F.floor(x * scale)))


def extent(made: DataFrame) -> tuple[int, float]:
    """Largest number of components and a bound of every inner product, 1 without rows."""
    square = F.aggregate("v", F.lit(0.0), lambda total, x: total + x.cast("double") * x)
    dim, most = made.agg(F.max(F.size("v")), F.max(square)).first()
    bound = (most or 0.0) * (1 + 1e-9) + 1
    if bound >= 1 << 62:
        raise ValueError("inner products of these vectors do not fit a long")
    return dim or 0, bound


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of a list column as rows of doubles; short ones are filled with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(column) and (sizes == dim).all():
        return values.reshape(-1, dim)
    out = np.zeros((len(column), dim))
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """Exact inner products, at most ``bound``, of the rows of two matrices of whole numbers."""
    if bound < _EXACT:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def slices(n: int, size: int) -> Iterator[slice]:
    """Parts of ``n`` places, ``size`` each."""
    for start in range(0, n, size):
        yield slice(start, min(n, start + size))


def blocks(queries: DataFrame, block: int = BLOCK) -> Iterator[list]:
    """The rows of ``queries``, which have a column ``key``, in lists of about ``block``.

    Only one list is on the driver at a time, and none grows with the table.
    """
    n = queries.count()
    parts = max(1, math.ceil(n / block))
    part = F.pmod(F.xxhash64("key"), F.lit(parts))
    for i in range(parts if n else 0):
        rows = queries.where(part == i).collect()
        if rows:
            yield sorted(rows, key=lambda r: r["key"])


def as_matrix(vectors: Sequence[Sequence[int]], dim: int) -> np.ndarray:
    """Vectors on the driver as ``matrix`` makes them."""
    return matrix(pa.array(vectors, pa.list_(pa.int64())), dim)


def best_of_groups(group: np.ndarray, order: Sequence[np.ndarray], most) -> np.ndarray:
    """Places of the first ``most`` entries of each group; ``order`` has the last key first."""
    by = np.lexsort((*order, group))
    sorted_groups = group[by]
    new = np.r_[True, sorted_groups[1:] != sorted_groups[:-1]] if len(by) else np.empty(0, bool)
    starts = np.flatnonzero(new)
    rank = np.arange(len(by)) - np.repeat(starts, np.diff(np.r_[starts, len(by)]))
    limit = most[sorted_groups] if isinstance(most, np.ndarray) else most
    return by[rank < limit]
