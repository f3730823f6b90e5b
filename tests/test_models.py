from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator

from offerlift.operators.evaluation import auc_score
from offerlift.operators.features import encoder, indexer
from offerlift.operators.projection import as_label
from offerlift.operators.sampling import hash_split
from offerlift.operators.ordering import latest_n
from offerlift.plans import scoring, training
from offerlift.sources import registry
from offerlift.sources.retail import FEATURES, interactions, requests
from offerlift.sources.workspace import new_path

ID = "interaction_id"


@pytest.fixture(scope="module")
def split(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    rows = as_label(interactions(spark, sf_dir, [ID, *FEATURES, "conversion"]))
    return hash_split(training.training_rows(rows, ID), ID)


def test_forest_finds_the_planted_signal(split):
    train, test = split
    model = training.fit_pipeline(train, training.random_forest(), ID)
    scored = training.holdout_predictions(model, test, ID).cache()
    assert scored.count() == test.where("label is not null").count()
    assert scored.where("prediction not in (0, 1) or score < 0 or score > 1").count() == 0
    assert auc_score(scored).first()["auc_score"] > 0.65


def test_grid_points_differ_and_the_best_is_kept(spark, split):
    train, test = split
    model, found = training.cross_validate(
        train, training.random_forest(), {"numTrees": [2, 4], "maxDepth": [3]}, ID, folds=2
    )
    points = training.grid_results(spark, found).collect()
    assert sorted(p["params"]["numTrees"] for p in points) == [2.0, 4.0]
    best = max(points, key=lambda p: p["avg_metric"])
    assert model.stages[-1].getNumTrees == best["params"]["numTrees"]
    assert training.holdout_predictions(model, test, ID).count() > 0


def test_oversampled_model_scores_plain_rows(split):
    train, test = split
    model = training.fit_oversampled(train, training.boosted_trees(maxIter=3, maxDepth=2), ID)
    scored = training.holdout_predictions(model, test, ID).cache()
    assert scored.count() == test.where("label is not null").count()
    assert auc_score(scored).first()["auc_score"] > 0.65
    plain = training.fit_pipeline(train, training.boosted_trees(maxIter=3, maxDepth=2), ID)
    found = [
        training.holdout_predictions(m, test, ID).where("prediction = 1").count()
        for m in (plain, model)
    ]
    assert found[1] > found[0]  # a rebalanced model dares to predict the minority


def test_folds_are_judged_on_their_own_rows(split, monkeypatch):
    """Rebalancing sees the training part of a fold; no synthetic row is validated."""
    train, _ = split
    seen, judged = [], []

    def rebalance(rows):
        made = training.rebalanced(rows, ID)
        seen.append(({r[0] for r in rows.select(ID).collect()}, made.count(), rows.count()))
        return made

    class Recording(MulticlassClassificationEvaluator):
        def evaluate(self, dataset, params=None):
            judged.append([(r[0], r[1]) for r in dataset.select(ID, "scaledFeatures").collect()])
            return super().evaluate(dataset, params)

    monkeypatch.setattr(training, "evaluator", lambda metric: Recording(labelCol="label"))
    grid = {"maxIter": [1], "maxDepth": [1, 2]}
    model, _ = training.cross_validate(
        train, training.boosted_trees(), grid, ID, folds=2, parallelism=1, rebalance=rebalance
    )
    known = {r[0] for r in train.where("label is not null").select(ID).collect()}
    assert len(seen) == 3 and len(judged) == 4  # once a fold, and once for the best model
    for i, validated in enumerate(judged):
        ids = [r[0] for r in validated]
        assert len(ids) == len(set(ids)) and set(ids) == known - seen[i // 2][0]
    assert all(made > given for _, made, given in seen)
    assert training.holdout_predictions(model, train, ID).count() == len(known)


def test_boosted_grid_is_bound(split):
    gbt = training.boosted_trees()
    grid = training.param_grid(gbt, training.BOOSTED_GRID)
    assert len(grid) == 4
    assert {p.parent for point in grid for p in point} == {gbt.uid}


def test_save_load_retrain_and_score(spark, sf_dir):
    table, root = f"r_{uuid.uuid4().hex}", new_path(spark, "models")
    registry.ensure_registry(spark, table, f"{root}/registry")
    rows = interactions(spark, sf_dir, [ID, *FEATURES, "conversion", "batch_tms"]).cache()
    sample = as_label(rows.drop("batch_tms"))
    unfitted = training.make_pipeline(sample, training.random_forest(numTrees=3), ID)
    start = dt.datetime(2024, 1, 31, 10)
    registry.save_ml(spark, unfitted, "spark_pipeline", root, table, "run-1", start)
    with pytest.raises(LookupError):
        registry.load_model(spark, table)
    for hour in (1, 2):
        at = start + dt.timedelta(hours=hour)
        location = scoring.retrain(spark, rows, table, root, f"run-{hour + 1}", n=900, now=at)
    assert location.endswith("/31012024120000")
    assert spark.table(table).count() == 3
    assert registry.latest_location(spark.table(table), "spark_model") == location
    scored = scoring.score_batch(rows, registry.load_model(spark, table), n=100)
    assert scored.columns == scoring.PREDICTION_COLUMNS
    assert scored.count() == 100
    assert scored.where("label is null").count() > 0  # scoring keeps unlabelled rows
    spark.sql(f"DROP TABLE {table}")


def test_requests_get_a_probability_each(spark, split, sf_dir):
    model = training.fit_serving_model(split[0])
    assert model.stages[-1].getNumTrees == 100 and model.stages[-1].getMaxDepth() == 2
    scored = scoring.score_requests(requests(spark, sf_dir), model)
    assert scored.columns == ["request_id", "prediction", "conversion_probability", "error"]
    asked = requests(spark, sf_dir).count()
    assert scored.count() == asked
    broken = scored.where("error is not null")
    assert 0 < broken.count() < asked / 50
    assert broken.where("prediction is not null").count() == 0
    good = scored.where("error is null and conversion_probability between 0 and 1")
    assert good.count() == asked - broken.count()


def test_a_category_unseen_in_training_is_scored(spark):
    train = spark.createDataFrame([("a",), ("a",), ("b",)], "c string")
    new = spark.createDataFrame([("z",)], "c string")
    indexed = indexer(["c"]).fit(train)
    assert indexed.transform(new).first()["c_StringIndex"] == 2.0
    both = indexed.transform(train.union(new))
    vectors = encoder(["c"]).fit(indexed.transform(train)).transform(both)
    assert [list(r[0]) for r in vectors.select("c_ClassVect").collect()][-1] == [0.0, 0.0]


def test_retrain_query_leaves_the_cut_to_the_operator(spark, sf_dir, monkeypatch):
    from offerlift.plans import queries

    class Stopped(Exception):
        pass

    def stop(spark, df, *args, n, complete, **kwargs):
        raise Stopped(df, n, complete)

    monkeypatch.setattr(queries.scoring, "retrain", stop)
    with pytest.raises(Stopped) as stopped:
        queries.QUERIES["retrain"](spark, sf_dir)
    df, n, complete = stopped.value.args
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert n == 20_000 and df.count() >= 0.9 * orders
    # The rows are those of a cut over all interactions, and only their lines are aggregated.
    newest = complete(latest_n(df.where("conversion is not null"), 300, "batch_tms", ID))
    columns = [ID, *FEATURES, "conversion", "batch_tms"]
    uncut = interactions(spark, sf_dir, columns).where("conversion is not null")
    want = latest_n(uncut, 300, "batch_tms", ID)
    assert newest.columns == columns and newest.exceptAll(want).count() == 0
    assert newest.count() == want.count() == 300
    steps = newest._jdf.queryExecution().optimizedPlan().toString().split("\n")
    lines = [i for i, row in enumerate(steps) if "l_orderkey" in row and "Aggregate" in row]
    joins = [i for i, row in enumerate(steps) if "Join LeftSemi" in row]
    assert lines and any(j > lines[0] for j in joins)


def test_training_rows_fill_all_cores_in_bounded_partitions(spark, monkeypatch):
    monkeypatch.setattr(training, "PARTITION_ROWS", 100)
    frame = spark.range(3000).withColumnRenamed("id", ID)
    rows = training.training_rows(frame, ID)
    cores = spark.sparkContext.defaultParallelism
    sizes = [n for n in rows.rdd.glom().map(len).collect() if n]
    assert len(sizes) >= cores and max(sizes) < 200 and sum(sizes) == 3000


def test_fewer_fits_at_a_time_for_more_rows(spark, split, monkeypatch):
    made, search = [], training.CrossValidator
    note = lambda **given: made.append(given["parallelism"]) or search(**given)
    monkeypatch.setattr(training, "CrossValidator", note)
    monkeypatch.setattr(training, "KEPT_ROWS", split[0].count())
    grid = {"numTrees": [2], "maxDepth": [2, 3]}
    _, found = training.cross_validate(split[0], training.random_forest(), grid, ID, folds=2)
    assert made == [1] and len(found.avgMetrics) == 2
