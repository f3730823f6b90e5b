"""Classification metrics as aggregations; no prediction leaves the cluster.

Everything on hard predictions starts from the (label, prediction) counts, one
partial aggregation over the rows. Score metrics first count outcomes per
distinct score, so tied scores share a point and cost one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlift.operators.ordering import with_running_totals


def class_balance(df: DataFrame, column: str = "label") -> DataFrame:
    return df.groupBy(column).count()


def class_count(df: DataFrame, column: str = "label") -> DataFrame:
    return df.agg(F.count_distinct(column).alias("classes"))


def require_binary(df: DataFrame, column: str = "label") -> DataFrame:
    """``df`` itself; raises unless the column holds exactly two classes."""
    classes = class_count(df, column).first()["classes"]
    if classes != 2:
        raise ValueError(f"{column} must hold exactly two classes, found {classes}")
    return df


def confusion_cells(df: DataFrame) -> DataFrame:
    return df.groupBy("label", "prediction").agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, by: str = "label") -> DataFrame:
    """Counts with true classes as rows, or predicted ones with ``by='prediction'``."""
    other = "prediction" if by == "label" else "label"
    columns = ["pred_neg", "pred_pos"] if by == "label" else ["neg", "pos"]
    return df.groupBy(by).agg(
        *[F.count(F.when(F.col(other) == v, 1)).alias(c) for v, c in enumerate(columns)]
    )


def _ratio(top, bottom):
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _per_class(df: DataFrame) -> DataFrame:
    cells = confusion_cells(df)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    as_truth = F.struct(
        F.col("label").cast("int").alias("class"),
        F.col("n").alias("support"),
        zero.alias("predicted"),
        hit.alias("hits"),
    )
    as_guess = F.struct(
        F.col("prediction").cast("int").alias("class"),
        zero.alias("support"),
        F.col("n").alias("predicted"),
        zero.alias("hits"),
    )
    totals = (
        cells.select(F.inline(F.array(as_truth, as_guess)))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    precision = _ratio(F.col("hits"), F.col("predicted"))
    recall = _ratio(F.col("hits"), F.col("support"))
    f1 = _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))
    return totals.withColumns({"precision": precision, "recall": recall, "f1": f1})


def class_report(df: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support of each class."""
    return _per_class(df).select(
        "class",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")],
        "support",
    )


def _weighted(metric: str):
    return F.sum(F.col(metric) * F.col("support")) / F.sum("support")


def class_report_summary(df: DataFrame) -> DataFrame:
    """The accuracy, macro and weighted rows under a class report."""
    metrics = ("precision", "recall", "f1")
    one = _per_class(df).agg(
        (F.sum("hits") / F.sum("support")).alias("accuracy"),
        F.sum("support").alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[_weighted(m).alias(f"weighted_{m}") for m in metrics],
    )
    rows = [
        F.struct(
            F.lit("accuracy").alias("row"),
            *[F.col("accuracy").alias(m) for m in metrics],
            F.col("support"),
        )
    ]
    rows += [
        F.struct(
            F.lit(f"{kind} avg").alias("row"),
            *[F.col(f"{kind}_{m}").alias(m) for m in metrics],
            F.col("support"),
        )
        for kind in ("macro", "weighted")
    ]
    return one.select(F.inline(F.array(*rows))).select(
        "row", *[F.round(m, 6).alias(m) for m in metrics], "support"
    )


def evaluate(df: DataFrame) -> DataFrame:
    """Accuracy and the class-weighted F1, precision and recall, as one row."""
    return _per_class(df).agg(
        F.round(F.sum("hits") / F.sum("support"), 6).alias("accuracy"),
        F.round(_weighted("f1"), 6).alias("f1"),
        F.round(_weighted("precision"), 6).alias("weighted_precision"),
        F.round(_weighted("recall"), 6).alias("weighted_recall"),
    )


def auc_hard(df: DataFrame) -> DataFrame:
    """Area under the ROC curve of the 0/1 prediction itself (one inner point)."""

    def rate(label: int):
        of_class = F.when(F.col("label") == label, F.col("prediction").cast("double"))
        return F.avg(of_class)

    return df.agg(F.round((1 + rate(1) - rate(0)) / 2, 6).alias("auc_hard"))


def _score_counts(df: DataFrame, score: str, label: str) -> DataFrame:
    scored = df.where(F.col(score).isNotNull())
    return scored.groupBy(F.col(score).alias("threshold")).agg(
        F.count(F.when(F.col(label) == 1, 1)).alias("positives"),
        F.count(F.when(F.col(label) == 0, 1)).alias("negatives"),
    )


def _cumulative(df: DataFrame, score: str, label: str) -> DataFrame:
    return with_running_totals(
        _score_counts(df, score, label),
        [F.desc("threshold")],
        {"true_positives": "positives", "false_positives": "negatives"},
    )


def roc_curve(
    df: DataFrame, score: str = "score", label: str = "label", origin: bool = False
) -> DataFrame:
    """True and false positive rate at each distinct score.

    With ``origin``, the point (0, 0) that a plotted curve starts at comes too,
    with a null threshold.
    """
    points = _cumulative(df, score, label).select(
        "threshold",
        "true_positives",
        "false_positives",
        F.round(_ratio(F.col("true_positives"), F.col("true_positives_total")), 6).alias("tpr"),
        F.round(_ratio(F.col("false_positives"), F.col("false_positives_total")), 6).alias("fpr"),
    )
    if not origin:
        return points
    zero = points.sparkSession.range(1).select(
        *[
            F.lit(None if f.name == "threshold" else 0).cast(f.dataType).alias(f.name)
            for f in points.schema
        ]
    )
    return points.unionByName(zero)


def auc_score(df: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """Exact area under the ROC curve of a score, ties counted half.

    Null when only one class occurs; rows with a null score are left out.
    """
    above = F.col("true_positives") - F.col("positives") / 2
    area = F.sum(F.col("negatives").cast("double") * above)
    pairs = F.sum("positives").cast("double") * F.sum("negatives").cast("double")
    auc = F.round(F.try_divide(area, pairs), 6)
    return _cumulative(df, score, label).agg(auc.alias("auc_score"))
