"""Accuracy over time and metric records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from offerlift.functions.timestamps import (
    duration_micros,
    from_epoch_ms,
    sub_second_nanos,
)
from offerlift.operators.ordering import with_row_index
from offerlift.operators.projection import drop_missing

#: Types of metrics that are not plain numbers with a fraction.
METRICS = {
    "prediction": T.IntegerType(),
    "conversion_probability": T.DoubleType(),
    "final_label": T.IntegerType(),
    "accuracy": T.DoubleType(),
}
#: Columns that metrics of unknown names may become.
MOST_COLUMNS = 1000


def threshold_label(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    return df.withColumn("response_label", (F.col(probability) >= threshold).cast("int"))


def attach_labels(predictions: DataFrame, truth: DataFrame, key: str = "uuid") -> DataFrame:
    """Predictions with the outcome that arrived for them later."""
    return predictions.join(truth, key)


def unlabelled(predictions: DataFrame, truth: DataFrame, key: str = "uuid") -> DataFrame:
    """Predictions whose outcome has not arrived."""
    return predictions.join(truth.select(key), key, "left_anti")


def block_accuracy(
    df: DataFrame,
    n: int,
    time_col: str,
    key: str,
    group_by: Sequence[str] = (),
    label: str = "final_label",
    prediction: str = "response_label",
) -> DataFrame:
    """Accuracy, first and last time of each full block of ``n`` responses in
    time order; a trailing partial block gives no row."""
    indexed = with_row_index(
        df.select(*group_by, time_col, key, label, prediction), [time_col, key], group_by
    )
    block = F.floor((F.col("row_index") - 1) / n).cast("bigint")
    return full_blocks(
        block_parts(indexed.withColumn("block", block), time_col, group_by, label, prediction),
        n,
        group_by,
    )


def block_parts(
    df: DataFrame, time_col: str, group_by: Sequence[str], label: str, prediction: str
) -> DataFrame:
    """Counts of a block, or of the part of it that ``df`` holds."""
    return df.groupBy(*group_by, "block").agg(
        F.count("*").alias("responses"),
        F.sum((F.col(label) == F.col(prediction)).cast("int")).alias("correct"),
        F.min(time_col).alias("started_at"),
        F.max(time_col).alias("ended_at"),
    )


def full_blocks(parts: DataFrame, n: int, group_by: Sequence[str] = ()) -> DataFrame:
    whole = parts.groupBy(*group_by, "block").agg(
        F.sum("responses").alias("responses"),
        F.sum("correct").alias("correct"),
        F.min("started_at").alias("started_at"),
        F.max("ended_at").alias("ended_at"),
    )
    return whole.where(F.col("responses") == n).select(
        *group_by,
        "block",
        "started_at",
        "ended_at",
        F.round(F.col("correct") / F.col("responses"), 6).alias("accuracy"),
    )


def accuracy_drift(blocks: DataFrame, group_by: Sequence[str] = ()) -> DataFrame:
    """Change of accuracy against the block before.

    Each block is sent to its own number and to the next one, which pairs
    neighbours by hash instead of sorting all blocks in one task.
    """
    nothing = F.lit(None).cast("double")
    accuracy = F.col("accuracy")
    own = F.struct(
        *group_by, "block", accuracy.alias("accuracy"), nothing.alias("previous_accuracy")
    )
    following = F.struct(
        *group_by,
        (F.col("block") + 1).alias("block"),
        nothing.alias("accuracy"),
        accuracy.alias("previous_accuracy"),
    )
    return (
        blocks.select(F.inline(F.array(own, following)))
        .groupBy(*group_by, "block")
        .agg(*[F.max(c).alias(c) for c in ("accuracy", "previous_accuracy")])
        .where(F.col("accuracy").isNotNull())
        .withColumn("drift", F.round(F.col("accuracy") - F.col("previous_accuracy"), 6))
    )


def _parsed(records: DataFrame) -> DataFrame:
    return records.withColumn("metrics", F.from_json("metrics", "map<string,string>"))


def metric_values(records: DataFrame) -> DataFrame:
    """Nested metric records to one row per record and metric, whatever the metrics are.

    ``value`` is the text of the metric, ``number`` the same as a double, null for
    what is no number. Records without metrics, null or broken ones give no row.
    This is the shape to store where metric names are open.
    """
    keep = [c for c in records.columns if c != "metrics"]
    rows = _parsed(records).select(*keep, F.explode("metrics").alias("metric", "value"))
    return rows.withColumn("number", F.col("value").try_cast("double"))


def flatten_metrics(
    records: DataFrame,
    separator: str = "_",
    names: Sequence[str] | None = None,
    most: int = MOST_COLUMNS,
) -> DataFrame:
    """Nested metric records to one column per metric, ``metrics_<name>``.

    The known metrics always have a column, then ``names``, as doubles. Without
    ``names`` every other metric of the records gets one; more than ``most`` such
    metrics are refused, since each is a column and its name comes to the driver.
    ``metric_values`` has no such bound.
    """
    parsed = _parsed(records)
    if names is None:
        found = parsed.select(F.explode(F.map_keys("metrics")).alias("name"))
        found = found.where(~F.col("name").isin(*METRICS)).distinct().limit(most + 1)
        names = found.agg(F.collect_set("name").alias("names")).first()["names"]
        if len(names) > most:
            raise ValueError(f"over {most} metrics; name the ones wanted or use metric_values")
    others = sorted(set(names) - METRICS.keys())
    kinds = METRICS | {name: T.DoubleType() for name in others}
    keep = [c for c in records.columns if c != "metrics"]
    return parsed.select(
        *keep,
        *[
            F.col("metrics")[m].try_cast(kind).alias(f"metrics{separator}{m}")
            for m, kind in kinds.items()
        ],
    )


def with_metric_times(metrics: DataFrame) -> DataFrame:
    """Epoch milliseconds to timestamps, and the processing time.

    ``processing_micros`` is the whole duration; ``processing_time`` repeats the
    older measure, which drops full seconds.
    """
    start, end = F.col("started_at"), F.col("ended_at")
    timed = metrics.withColumns(
        {
            "started_at": from_epoch_ms(F.col("startTimeStampMs")),
            "ended_at": from_epoch_ms(F.col("endTimeStampMs")),
        }
    ).withColumn("processing_micros", duration_micros(start, end))
    return timed.withColumn("processing_time", sub_second_nanos(F.col("processing_micros")))


def metric_series(
    metrics: DataFrame, metric: str, time_col: str = "startTimeStampMs", key: str = "uuid"
) -> DataFrame:
    """One metric in time order, numbered from 1, rows without it left out."""
    present = drop_missing(metrics.select(key, time_col, metric), metric)
    return with_row_index(present, [time_col, key], name="position")


def tail_transposed(
    metrics: DataFrame, n: int = 5, time_col: str = "startTimeStampMs", key: str = "uuid"
) -> DataFrame:
    """The last ``n`` records turned on their side: one row per metric and record."""
    last = metrics.orderBy(F.desc(time_col), F.desc(key)).limit(n)
    # n rows, so one task numbers them.
    numbered = last.withColumn(
        "position", F.row_number().over(Window.orderBy(time_col, key))
    )
    values = [c for c in metrics.columns if c != key]
    return numbered.select(
        "position", key, *[F.col(c).cast("double").alias(c) for c in values]
    ).unpivot(["position", key], values, "metric", "value")
