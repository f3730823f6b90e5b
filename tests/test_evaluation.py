from __future__ import annotations

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from offerlift.operators import evaluation, sampling
from offerlift.operators.profit import best_threshold, profit_curve
from offerlift.sources.retail import scored

# A published profit table (blast, targeted, threshold).
PUBLISHED = [
    (430700.0, 430700.0, 0.0),
    (430700.0, 491400.0, 0.1),
    (430700.0, 493600.0, 0.2),
    (430700.0, 493280.0, 0.3),
    (430700.0, 486020.0, 0.4),
    (430700.0, 482770.0, 0.5),
    (430700.0, 472330.0, 0.6),
    (430700.0, 457000.0, 0.7),
    (430700.0, 423090.0, 0.8),
    (430700.0, 332060.0, 0.9),
]


def test_metrics_agree_with_spark_ml(spark, sf_dir):
    df = scored(spark, sf_dir).select(
        "score", F.col("label").cast("double"), F.col("prediction").cast("double")
    ).cache()
    multi = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction")
    got = evaluation.evaluate(df).first()
    for ours, theirs in {
        "accuracy": "accuracy",
        "f1": "f1",
        "weighted_precision": "weightedPrecision",
        "weighted_recall": "weightedRecall",
    }.items():
        assert got[ours] == pytest.approx(multi.evaluate(df, {multi.metricName: theirs}), abs=1e-6)
    for column, value in {
        "prediction": evaluation.auc_hard(df).first()["auc_hard"],
        "score": evaluation.auc_score(df).first()["auc_score"],
    }.items():
        binary = BinaryClassificationEvaluator(
            labelCol="label", rawPredictionCol=column, metricName="areaUnderROC", numBins=0
        )
        assert value == pytest.approx(binary.evaluate(df), abs=1e-6)
    df.unpersist()


def test_tied_scores_count_half(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5), (0, 0.5)], "label int, score double")
    assert evaluation.auc_score(df).first()["auc_score"] == 0.5
    assert evaluation.roc_curve(df).count() == 1


def test_a_class_that_is_never_predicted(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0)], "label int, prediction int")
    rows = {r["class"]: r for r in evaluation.class_report(df).collect()}
    assert (rows[1]["precision"], rows[1]["recall"], rows[1]["support"]) == (0.0, 0.0, 1)
    assert rows[0]["recall"] == 1.0
    cells = evaluation.confusion_matrix(df).collect()
    matrix = {r["label"]: (r["pred_neg"], r["pred_pos"]) for r in cells}
    assert matrix == {0: (2, 0), 1: (1, 0)}


def test_binary_guard(spark):
    two = spark.createDataFrame([(0,), (1,), (1,)], "label int")
    assert evaluation.require_binary(two) is two
    for rows in ([(1,)], [(0,), (1,), (2,)], [(None,)]):
        with pytest.raises(ValueError):
            evaluation.require_binary(spark.createDataFrame(rows, "label int"))


def test_profit_curve_shape(spark, sf_dir):
    rows = sorted(profit_curve(scored(spark, sf_dir)).collect(), key=lambda r: r["threshold"])
    assert [r["threshold"] for r in rows] == [i / 10 for i in range(10)]
    assert len({r["blast_profit"] for r in rows}) == 1
    assert rows[0]["targeted_profit"] == rows[0]["blast_profit"]


def test_best_threshold_of_the_published_table(spark):
    schema = "blast_profit double, targeted_profit double, threshold double"
    curve = spark.createDataFrame(PUBLISHED, schema)
    best = best_threshold(curve).first()
    assert (best["threshold"], best["targeted_profit"], best["uplift"]) == (0.2, 493600.0, 62900.0)


def test_profit_of_nothing_is_zero(spark):
    empty = spark.createDataFrame([], "label int, score double")
    assert {r["targeted_profit"] for r in profit_curve(empty).collect()} == {0.0}


def test_split_is_disjoint_complete_and_stable(spark):
    df = spark.range(5000)
    a, b = sampling.hash_split(df, "id")
    ids = {r[0] for r in a.collect()}
    assert ids.isdisjoint(r[0] for r in b.collect())
    assert len(ids) + b.count() == 5000 and 0.77 < len(ids) / 5000 < 0.83
    again, _ = sampling.hash_split(df.repartition(7), "id")
    assert ids == {r[0] for r in again.collect()}


def test_folds_are_even(spark):
    counts = sampling.fold_assign(spark.range(10000), "id").groupBy("fold").count().collect()
    assert sorted(r["fold"] for r in counts) == list(range(5))
    assert all(abs(r["count"] - 2000) < 200 for r in counts)


def test_sample_takes_what_there_is(spark):
    assert sampling.sample_n(spark.range(50), 20, "id").count() == 20
    assert sampling.sample_n(spark.range(50), 80, "id").count() == 50


def test_undersampling_keeps_the_minority(spark):
    df = spark.range(4000).withColumn("label", (F.col("id") % 4 == 0).cast("int"))
    kept = sampling.undersample(df, 30, "id").groupBy("label").count().collect()
    counts = {r["label"]: r["count"] for r in kept}
    assert counts[1] == 1000 and 780 < counts[0] < 1020
    with pytest.raises(ValueError):
        sampling.undersample(df, 5, "id")
