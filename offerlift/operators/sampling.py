"""Splits, samples and folds drawn from each row's own key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlift.functions.hashing import hash_choice, hash_uniform


def hash_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 1):
    """``(first, second)``: disjoint, complete, and the same on every run."""
    u = hash_uniform(seed, key)
    return df.where(u < share), df.where(u >= share)


def with_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 1) -> DataFrame:
    return df.withColumn("is_train", (hash_uniform(seed, key) < share).cast("int"))


def random_split(df: DataFrame, share: float = 0.8, seed: int = 1):
    return df.randomSplit([share, 1 - share], seed=seed)


def sample_n(df: DataFrame, n: int, key: str, seed: str | int = 0) -> DataFrame:
    """Exactly ``n`` rows (all of them when there are fewer), uniformly drawn."""
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return df.orderBy(draw, key).limit(n)


def undersample(
    df: DataFrame, percentage: int, key: str, majority: int = 0, label: str = "label", seed="under"
) -> DataFrame:
    """Keep about ``percentage`` percent of the majority class and every other row."""
    if not 10 <= percentage <= 100:
        raise ValueError("the kept percentage of the majority must be in 10 - 100")
    kept = hash_uniform(seed, key) < percentage / 100
    return df.where((F.col(label) != majority) | kept)


def fold_assign(df: DataFrame, key: str, folds: int = 5, seed: str | int = "fold") -> DataFrame:
    return df.withColumn("fold", hash_choice(folds, seed, key))
