"""Physical plans of the operators that must hold at scale."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from offerlift.operators import evaluation, monitoring, projection, sampling
from offerlift.operators.features import frequency_index
from offerlift.operators.neighbours import nearest_neighbours
from offerlift.operators.ordering import latest_n
from offerlift.operators.profit import profit_curve
from offerlift.sources import retail
from offerlift.sources.workspace import new_path


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    """Interactions as the plain Parquet table they are in production."""
    path = new_path(spark, "plans")
    retail.interactions(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_schema(text: str) -> set[str]:
    return {f.split(":")[0] for f in text.split("ReadSchema: struct<")[1].split(">")[0].split(",")}


def test_projection_prunes_columns(stored):
    text = plan(projection.select_features(stored, ["history", "channel"]))
    assert read_schema(text) == {"history", "channel", "conversion"}


def test_class_and_null_filters_reach_the_scan(stored):
    text = plan(projection.by_class(projection.labelled(projection.as_label(stored)), 1))
    pushed = text.split("PushedFilters: [")[1].split("]")[0]
    assert "IsNotNull(conversion)" in pushed and "EqualTo(conversion,1)" in pushed


def test_newest_rows_are_a_top_k_over_a_filtered_scan(stored):
    text = plan(latest_n(stored.drop("name"), 20, "batch_tms", "interaction_id"))
    assert "TakeOrderedAndProject" in text
    assert "GreaterThanOrEqual(batch_tms" in text and "Exchange" not in text


def test_sampling_filters_need_no_shuffle(stored):
    train, test = sampling.hash_split(stored, "interaction_id")
    folds = sampling.fold_assign(train, "interaction_id")
    assert "Exchange" not in plan(folds) and "Exchange" not in plan(test)


def test_thresholds_share_one_pass_without_a_join(stored):
    text = plan(profit_curve(stored.withColumnRenamed("conversion", "label")))
    assert text.count("FileScan") == 1
    assert "Join" not in text and "CartesianProduct" not in text
    assert read_schema(text) == {"label", "score"} or read_schema(text) == {"conversion", "score"}


def test_reports_shuffle_only_partial_counts(stored):
    scored = stored.select(
        F.col("conversion").alias("label"), (F.col("score") >= 0.5).cast("int").alias("prediction")
    )
    text = plan(evaluation.class_report(scored))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert "partial_count" in text


def test_neighbour_groups_are_cut_before_each_shuffle(spark, stored):
    rows = stored.where("conversion = 1").drop("conversion")
    near = nearest_neighbours(rows, 5, "interaction_id", ["recency", "history"], retail.BLOCK)
    text = plan(near)
    assert text.count("row_number(), 6, Partial") >= 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_a_hot_key_is_split_by_the_join(spark):
    """Rows of one key, a third of all, are joined by several tasks."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        n = 200_000
        hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
        predictions = spark.range(n, numPartitions=8).select(
            hot.alias("uuid"), F.md5(F.col("id").cast("string")).alias("payload")
        )
        truth = spark.range(n).select(F.col("id").alias("uuid"), F.lit(1).alias("final_label"))
        joined = monitoring.attach_labels(predictions, truth)
        joined.write.format("noop").mode("overwrite").save()
        assert joined.count() == n
        joined = monitoring.attach_labels(predictions, truth)
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


FORBIDDEN = ("localCheckpoint", ".collect()", "toPandas", ".rdd", "crossJoin", "@F.udf")


def test_no_local_checkpoints_collects_or_python_udfs_in_the_package():
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "offerlift")
    for folder, folders, names in os.walk(root):
        # The optional corpus operators have rules of their own.
        folders[:] = [f for f in folders if f != "llm"]
        for name in names:
            if name.endswith(".py"):
                text = open(os.path.join(folder, name)).read()
                for word in FORBIDDEN:
                    assert word not in text, (name, word)


def test_order_lines_are_restricted_before_they_are_aggregated(spark, sf_dir):
    """Picking a few rows sends their keys to the scan of the lines."""
    from offerlift.plans.queries import QUERIES

    for name in ("peek", "latest_n", "latest_n_train", "sample_n", "ingest_batch"):
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().optimizedPlan().toString().split("\n")
        lines = [i for i, row in enumerate(plan) if "l_orderkey" in row and "Aggregate" in row]
        joins = [i for i, row in enumerate(plan) if "Join LeftSemi" in row]
        assert lines and any(j > lines[0] for j in joins), name


def test_all_columns_are_ranked_from_one_count(stored):
    """What is joined is the source, read once, and the written ranks of each column."""
    text = plan(frequency_index(stored, ["zip_code", "channel", "offer"]))
    assert text.count("FileScan parquet") == 1 + 3
    assert "Aggregate" not in text
