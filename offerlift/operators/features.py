"""Feature preparation with Spark ML stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlift.operators.evaluation import require_binary
from offerlift.operators.ordering import with_row_index
from offerlift.sources.workspace import materialize


def indexer(categorical: Sequence[str]) -> StringIndexer:
    """Frequency-ranked category indices, all columns counted in one pass.

    A category unseen in fitting gets an index of its own instead of an error.
    """
    return StringIndexer(
        inputCols=list(categorical),
        outputCols=[f"{c}_StringIndex" for c in categorical],
        handleInvalid="keep",
    )


def frequency_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_StringIndex``: rank of the value by frequency, then by value, from 0.

    For columns with any number of values: nothing of them comes to the driver,
    as the stage of ``indexer`` would do. All columns are counted in one pass
    over ``df`` and ranked together, as text. Nulls stay null.
    """
    entries = [
        F.struct(F.lit(c).alias("__column"), F.col(c).cast("string").alias("__value"))
        for c in columns
    ]
    values = df.select(F.inline(F.array(*entries))).where("__value is not null")
    counts = values.groupBy("__column", "__value").agg(F.count("*").alias("__n"))
    order = [F.desc("__n"), F.col("__value")]
    ranked = materialize(with_row_index(counts, order, ["__column"], "__rank"), "ranks")
    for c in columns:
        index = (F.col("__rank") - 1).cast("double").alias(f"{c}_StringIndex")
        ranks = ranked.where(F.col("__column") == c).select(F.col("__value").alias("__key"), index)
        df = df.join(ranks, F.col(c).cast("string") == F.col("__key"), "left").drop("__key")
    return df


def encoder(categorical: Sequence[str]) -> OneHotEncoder:
    """One-hot vectors; the dropped last slot is that of unseen categories."""
    return OneHotEncoder(
        inputCols=[f"{c}_StringIndex" for c in categorical],
        outputCols=[f"{c}_ClassVect" for c in categorical],
    )


def assembler(categorical: Sequence[str], numeric: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(
        inputCols=[*[f"{c}_ClassVect" for c in categorical], *numeric], outputCol="features"
    )


def feature_stages(categorical: Sequence[str], numeric: Sequence[str], scale: bool = False) -> list:
    stages: list = []
    if categorical:
        stages += [indexer(categorical), encoder(categorical)]
    stages.append(assembler(categorical, numeric))
    if scale:
        stages.append(
            StandardScaler(
                inputCol="features", outputCol="scaledFeatures", withMean=True, withStd=True
            )
        )
    return stages


def feature_pipeline(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str]
) -> tuple[DataFrame, Pipeline]:
    """The features of ``df``, scaled, and the unfitted pipeline that made them."""
    pipeline = Pipeline(stages=feature_stages(categorical, numeric, scale=True))
    return pipeline.fit(df).transform(df), pipeline


def vectorize(df: DataFrame, target: str, key: str | None = None) -> DataFrame:
    """``features`` from every other column, and the target as ``label``.

    Raises unless the target holds exactly two classes.
    """
    inputs = [c for c in df.columns if c not in (target, key)]
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(
        require_binary(df, target)
    )
    keep = [] if key is None else [key]
    return assembled.select(*keep, "features", F.col(target).alias("label"))


def standard_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``<column>_scaled``: minus the mean, over the sample standard deviation."""
    stages = feature_stages([], columns, scale=True)
    scaled = Pipeline(stages=stages).fit(df).transform(df)
    values = scaled.withColumn("__v", vector_to_array("scaledFeatures"))
    return values.select(
        *df.columns, *[F.col("__v")[i].alias(f"{c}_scaled") for i, c in enumerate(columns)]
    )
