"""Scoring of table rows and of requests, and retraining."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlift.operators.ordering import latest_n
from offerlift.operators.projection import as_label, labelled, parse_requests, select_features
from offerlift.plans.training import SERVING_FEATURES, positive_probability
from offerlift.sources.registry import load_pipeline, save_ml
from offerlift.sources.tables import append
from offerlift.sources.retail import BLOCK, FEATURES, TARGET
from offerlift.sources.workspace import materialize

PREDICTION_COLUMNS = [
    *FEATURES,
    "label",
    *[f"{c}_StringIndex" for c in BLOCK],
    "prediction",
]


def with_target_as_label(df: DataFrame) -> DataFrame:
    return as_label(df, TARGET)


def prediction_columns(df: DataFrame) -> DataFrame:
    return df.select(*PREDICTION_COLUMNS)


def score_batch(
    df: DataFrame,
    model: PipelineModel,
    n: int = 1000,
    time_col: str = "batch_tms",
    key: str = "interaction_id",
    day_col: str | None = None,
) -> DataFrame:
    """Predictions for the ``n`` newest interactions, labelled or not."""
    newest = latest_n(df, n, time_col, key, day_col)
    return prediction_columns(model.transform(with_target_as_label(newest)))


def score_into(df: DataFrame, model: PipelineModel, table: str) -> None:
    """Append the predictions for all rows of ``df`` to the prediction table."""
    append(prediction_columns(model.transform(with_target_as_label(df))), table)


def score_requests(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Prediction and conversion probability for each JSON request.

    A request that cannot be read keeps its row, with nulls and the ``error``.
    """
    parsed = parse_requests(df, SERVING_FEATURES)
    # The model refuses nulls; what it makes of the filler is not returned.
    scored = positive_probability(model.transform(parsed.fillna(0.0, SERVING_FEATURES)))
    good = F.col("error").isNull()
    return scored.select(
        *[c for c in df.columns if c != "body"],
        F.when(good, F.col("prediction")).alias("prediction"),
        F.when(good, F.col("conversion_probability")).alias("conversion_probability"),
        "error",
    )


def retrain(
    spark: SparkSession,
    df: DataFrame,
    registry: str,
    root: str,
    run_id: str,
    n: int = 20000,
    time_col: str = "batch_tms",
    key: str = "interaction_id",
    day_col: str | None = None,
    now: dt.datetime | None = None,
    complete: Callable[[DataFrame], DataFrame] = lambda newest: newest,
) -> str:
    """Fit the newest registered pipeline on the newest labelled rows and register the result.

    Where features are costly to derive, ``df`` need only tell the newest labelled
    rows (time, key, target), and ``complete`` makes feature rows of the ``n`` found.
    """
    newest = complete(latest_n(labelled(df, TARGET), n, time_col, key, day_col))
    rows = materialize(as_label(select_features(newest)))  # fitting rereads them
    model = load_pipeline(spark, registry).fit(rows)
    return save_ml(spark, model, "spark_model", root, registry, run_id, now)
