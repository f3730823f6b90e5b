"""Reproducible pseudo-random numbers.

``rand()`` depends on how rows are partitioned, so a retried task may draw
other numbers than the first attempt. A number derived from the row's own key
is the same on every attempt and on every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296.0


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_uniform(seed: str | int, *keys: Column | str) -> Column:
    """Uniform double in [0, 1) from ``md5(seed:key[:key...])``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_column(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(TWO_POW_32)


def hash_choice(n: Column | int, seed: str | int, *keys: Column | str) -> Column:
    """Uniform integer in ``[0, n)``; ``n`` may be a column."""
    n = n if isinstance(n, Column) else F.lit(n)
    return F.floor(hash_uniform(seed, *keys) * n).cast("int")
