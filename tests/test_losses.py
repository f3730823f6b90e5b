"""Input that must not be lost without a word."""

from __future__ import annotations

import pytest

from offerlift.operators import evaluation, features, monitoring, neighbours, sampling


def test_unknown_metrics_get_a_column(spark):
    rows = [("a", 1, 2, '{"accuracy": 0.5, "latency_ms": 12.5}'), ("b", 1, 2, '{"prediction": 1}')]
    df = spark.createDataFrame(rows, "uuid string, startTimeStampMs long, endTimeStampMs long, metrics string")
    got = {r["uuid"]: r for r in monitoring.flatten_metrics(df).collect()}
    assert got["a"]["metrics_latency_ms"] == 12.5 and got["b"]["metrics_latency_ms"] is None
    assert got["b"]["metrics_prediction"] == 1 and got["a"]["metrics_accuracy"] == 0.5


def test_open_metric_names_stay_rows_and_only_named_ones_become_columns(spark):
    body = "concat('{\"accuracy\": 0.5, \"m', id, '\": \"', id, '\", \"host\": \"h\"}')"
    df = spark.range(100_000).selectExpr("cast(id as string) as uuid", f"{body} as metrics")
    df = df.unionByName(spark.createDataFrame([("n", None), ("b", "{"), ("e", "{}")], "uuid string, metrics string"))
    long = monitoring.metric_values(df)
    assert long.select("metric").distinct().count() == 100_002
    row = long.where("metric = 'm77'").first()
    assert (row["uuid"], row["value"], row["number"]) == ("77", "77", 77.0)
    assert long.where("metric = 'host' and number is null").count() == 100_000
    assert long.where("uuid in ('n', 'b', 'e')").count() == 0
    with pytest.raises(ValueError, match="over 1000 metrics"):
        monitoring.flatten_metrics(df)
    wide = monitoring.flatten_metrics(df, names=["m77", "accuracy"])
    assert wide.columns[-1] == "metrics_m77" and wide.count() == 100_003
    assert wide.where("metrics_m77 is not null").count() == 1


@pytest.mark.parametrize("row", [(None, 1, "x"), (9, None, "x"), (9, 1, None)])
def test_neighbours_refuse_nulls(spark, row):
    rows = [(i, i, "x") for i in range(5)] + [row]
    df = spark.createDataFrame(rows, "id long, v int, block string")
    with pytest.raises(Exception, match="null in column"):
        neighbours.nearest_neighbours(df, 2, "id", ["v"], ["block"]).collect()


def test_area_of_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.7), (1, None)], "label int, score double")
    assert evaluation.auc_score(df).first()["auc_score"] is None


def test_a_plotted_curve_starts_at_the_origin(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.4)], "label int, score double")
    points = evaluation.roc_curve(df, origin=True)
    assert sorted((r["fpr"], r["tpr"]) for r in points.collect()) == [(0, 0), (0, 1), (1, 1)]
    assert evaluation.roc_curve(df).count() == 2


def test_frequency_index_keeps_nulls_and_ranks_ties_by_value(spark):
    df = spark.createDataFrame([(i, c) for i, c in enumerate("bbaac") ] + [(9, None)], "id int, c string")
    got = {r["id"]: r["c_StringIndex"] for r in features.frequency_index(df, ["c"]).collect()}
    assert got == {0: 1.0, 1: 1.0, 2: 0.0, 3: 0.0, 4: 2.0, 9: None}


def test_random_split_loses_nothing(spark):
    first, second = sampling.random_split(spark.range(1000), 0.8)
    assert first.union(second).distinct().count() == 1000
    assert 700 < first.count() < 900
