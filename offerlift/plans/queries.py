"""The query catalogue: each operator applied to whole tables.

A query takes the session and the folder of the tables and returns a frame.
Training and table queries run jobs while they are built; the rest are lazy.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.functions import hashing, paths, timestamps
from offerlift.operators import evaluation, features, monitoring, neighbours, ordering
from offerlift.operators import pivots, profit, projection, sampling, smote as oversampling
from offerlift.plans import scoring, training
from offerlift.sources import files, registry, retail, tables
from offerlift.sources.retail import BLOCK, FEATURES, interactions
from offerlift.sources.workspace import materialize, new_path
from offerlift.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ID = "interaction_id"
NUMERIC = ["recency", "history", "used_discount", "used_bogo", "is_referral"]
#: Newest labelled rows of ``latest_n_train``, fewer than the tables have.
TRAIN_ROWS = 5000
#: What the area under the curve of every fitted model has to exceed.
LEAST_AUC = 0.6
STAMP = dt.datetime(2024, 2, 1)


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _stamp():
    return F.lit(STAMP).cast("timestamp_ntz")


def _table_name(purpose: str, location: str) -> str:
    return f"{purpose}_{location.rsplit('-', 1)[-1]}"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources and sinks -------------------------------------------------------

CSV_COLUMNS = [ID, "name", "recency", "history", "channel", "conversion"]


def _as_csv(spark: SparkSession, sf_dir: str, *extra: str) -> str:
    path = new_path(spark, "csv")
    rows = interactions(spark, sf_dir, [*CSV_COLUMNS, *extra])
    rows.write.option("header", True).csv(path)
    return path


@query
def scan_csv(spark, sf_dir):
    return files.read_csv(spark, _as_csv(spark, sf_dir))


@query
def scan_csv_infer(spark, sf_dir):
    df = files.read_csv(spark, _as_csv(spark, sf_dir, "score"), infer=True)
    return df.withColumn(ID, F.col(ID).cast("bigint"))


@query
def scan_interactions(spark, sf_dir):
    return interactions(spark, sf_dir)


@query
def scan_projected(spark, sf_dir):
    return projection.select_features(interactions(spark, sf_dir))


@query
def peek(spark, sf_dir):
    orders = ordering.peek(retail.read(spark, sf_dir, "orders"), "o_orderkey", 10)
    return interactions(spark, sf_dir, [ID, *FEATURES], orders, few=True)


@query
def column_roles(spark, sf_dir):
    rows = projection.select_features(interactions(spark, sf_dir))
    return projection.role_rows(rows, "conversion")


def _stored_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    location = new_path(spark, "interactions")
    table = _table_name("interactions", location)
    months = ("batch_month",)
    tables.ensure_table(spark, table, tables.INTERACTIONS, True, months, location)
    try:
        rows = interactions(spark, sf_dir)
        month = F.trunc(F.to_date("batch_tms"), "month")
        tables.append(rows.withColumn("batch_month", month).repartition("batch_month"), table)
        tables.ensure_table(spark, table, tables.INTERACTIONS)  # exists: left as it is
        return materialize(spark.table(table))
    finally:
        spark.sql(f"DROP TABLE {table}")


@query
def ensure_table(spark, sf_dir):
    stored = _stored_interactions(spark, sf_dir)
    return stored.groupBy("batch_id").agg(
        F.count("*").alias("rows"), F.count("conversion").alias("labelled")
    )


@query
def append_interactions(spark, sf_dir):
    stored = _stored_interactions(spark, sf_dir)
    return stored.withColumns(
        {
            "score": F.round(F.col("score").cast("double"), 4),
            "batch_month": F.col("batch_month").cast("string"),
        }
    )


@query
def stamp_batch(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, *FEATURES, "conversion"])
    return projection.stamp_batch(df, F.lit("historical"), _stamp())


@query
def ingest_batch(spark, sf_dir):
    orders = sampling.sample_n(retail.read(spark, sf_dir, "orders"), 1000, "o_orderkey")
    rows = interactions(spark, sf_dir, [ID, *FEATURES, "conversion"], orders, few=True)
    return projection.ingest_batch(rows, F.lit("batch-1"), _stamp())


@query
def registry_append(spark, sf_dir):
    location = new_path(spark, "registry")
    table = _table_name("registry", location)
    registry.ensure_registry(spark, table, location)
    runs = retail.registry_rows(spark, sf_dir)
    try:
        registry.register(runs.where(F.col("object_kind") != "sklearn_model"), table)
        registry.register(runs, table)  # runs already there are not added twice
        return materialize(registry.registered(spark, table))
    finally:
        spark.sql(f"DROP TABLE {table}")


@query
def registry_list(spark, sf_dir):
    return retail.registry_rows(spark, sf_dir)


@query
def registry_latest(spark, sf_dir):
    return registry.latest(retail.registry_rows(spark, sf_dir))


@query
def artifact_list(spark, sf_dir):
    root = new_path(spark, "artifacts")
    counts = retail.artifact_names(spark, sf_dir).groupBy("artifact").count()
    counts.withColumn("folder", F.col("artifact")).write.partitionBy("folder").parquet(root)
    found = files.list_artifacts(spark, root)
    return found.where(F.col("artifact").startswith("folder=")).select(
        F.regexp_replace("artifact", "^folder=", "").alias("artifact")
    )


@query
def artifact_latest(spark, sf_dir):
    names = retail.artifact_names(spark, sf_dir).distinct()
    return files.latest_artifact(names, "pipeline")


@query
def metrics_flatten(spark, sf_dir):
    return monitoring.flatten_metrics(retail.metric_events(spark, sf_dir))


@query
def metrics_long(spark, sf_dir):
    rows = monitoring.metric_values(retail.metric_events(spark, sf_dir))
    return rows.select("uuid", "metric", F.round("number", 6).alias("number"))


@query
def metrics_snapshot(spark, sf_dir):
    location = new_path(spark, "metrics")
    table = _table_name("metrics", location)
    metrics = monitoring.flatten_metrics(retail.metric_events(spark, sf_dir))
    try:
        tables.write_if_absent(metrics, table, location)
        tables.write_if_absent(metrics.where(F.lit(False)), table, location)  # ignored
        return materialize(spark.table(table))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")


@query
def lineage_edges(spark, sf_dir):
    edges = registry.lineage_edges(retail.lineage_rows(spark, sf_dir))
    return edges.select("model_name", "table_name", F.col("metadata")["trigger"].alias("trigger"))


# --- projections and filters -------------------------------------------------


@query
def label_rename(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, *FEATURES, "conversion"])
    return projection.as_label(projection.select_features(df, [ID, *FEATURES]))


@query
def cast_int(spark, sf_dir):
    orders = retail.read(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("string").alias("history_text"),
        (F.col("o_totalprice") / 1000).alias("history"),
        (hashing.hash_uniform("s", "o_orderkey") * 10).alias("score"),
        F.col("o_orderpriority").alias("not_a_number"),
    )
    return projection.cast_int(orders, ["history_text", "history", "score", "not_a_number"])


@query
def vectorize(spark, sf_dir):
    rows = interactions(spark, sf_dir, [ID, *NUMERIC, "conversion"])
    df = projection.labelled(rows, "conversion")
    values = features.vectorize(df, "conversion", ID).withColumn("v", vector_to_array("features"))
    return values.select(ID, *[F.col("v")[i].alias(f"f{i}") for i in range(len(NUMERIC))], "label")


@query
def class_filter(spark, sf_dir):
    df = projection.as_label(interactions(spark, sf_dir, [ID, *NUMERIC, "conversion"]))
    return projection.by_class(df, 1)


@query
def location_normalize(spark, sf_dir):
    return retail.registry_rows(spark, sf_dir).select(
        "run_id", "location", paths.normalize_location(F.col("location")).alias("normalized")
    )


@query
def labelled_only(spark, sf_dir):
    df = projection.as_label(interactions(spark, sf_dir, [ID, *FEATURES, "conversion"]))
    return projection.labelled(df)


@query
def parse_requests(spark, sf_dir):
    return projection.parse_requests(retail.requests(spark, sf_dir), training.SERVING_FEATURES)


# --- joins -------------------------------------------------------------------


@query
def delayed_labels(spark, sf_dir):
    return monitoring.attach_labels(retail.predictions(spark, sf_dir), retail.truth(spark, sf_dir))


@query
def awaiting_labels(spark, sf_dir):
    return monitoring.unlabelled(retail.predictions(spark, sf_dir), retail.truth(spark, sf_dir))


def _minority(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    wanted = dict.fromkeys([ID, *BLOCK, "recency", "history", *extra, "conversion"])
    return projection.as_label(interactions(spark, sf_dir, list(wanted)))


@query
def knn_minority(spark, sf_dir):
    minority = materialize(projection.by_class(_minority(spark, sf_dir), 1))
    near = neighbours.nearest_neighbours(minority, 5, ID, ["recency", "history"], BLOCK)
    return neighbours.neighbour_rows(near, ID)


@query
def knn_minority_unblocked(spark, sf_dir):
    minority = materialize(projection.by_class(_minority(spark, sf_dir), 1))
    near = neighbours.nearest_neighbours(minority, 3, ID, ["recency", "history"])
    return neighbours.neighbour_rows(near, ID)


@query
def knn_vectors(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    near = neighbours.neighbour_rows(pivots.nearest_vectors(table, 5, "vec_id", "embedding"), "vec_id")
    return _rounded(near, "dist2")


# --- aggregations ------------------------------------------------------------


@query
def class_balance(spark, sf_dir):
    return evaluation.class_balance(interactions(spark, sf_dir, ["conversion"]), "conversion")


@query
def binary_guard(spark, sf_dir):
    return evaluation.class_count(retail.scored(spark, sf_dir))


@query
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(retail.scored(spark, sf_dir))


@query
def confusion_matrix_t(spark, sf_dir):
    return evaluation.confusion_matrix(retail.scored(spark, sf_dir), by="prediction")


@query
def class_report(spark, sf_dir):
    return evaluation.class_report(retail.scored(spark, sf_dir))


@query
def class_report_summary(spark, sf_dir):
    return evaluation.class_report_summary(retail.scored(spark, sf_dir))


@query
def eval_metrics(spark, sf_dir):
    return evaluation.evaluate(retail.scored(spark, sf_dir))


@query
def auc_hard(spark, sf_dir):
    return evaluation.auc_hard(retail.scored(spark, sf_dir))


@query
def auc_score(spark, sf_dir):
    return evaluation.auc_score(retail.scored(spark, sf_dir))


@query
def roc_points(spark, sf_dir):
    return evaluation.roc_curve(retail.scored(spark, sf_dir))


@query
def profit_curve(spark, sf_dir):
    return profit.profit_curve(retail.scored(spark, sf_dir))


@query
def profit_best(spark, sf_dir):
    return profit.best_threshold(profit_curve(spark, sf_dir))


# --- windows and top-k -------------------------------------------------------


def _labelled_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return monitoring.attach_labels(
        retail.predictions(spark, sf_dir), retail.truth(spark, sf_dir).drop("labelled_at")
    )


@query
def block_accuracy(spark, sf_dir):
    rows = _labelled_predictions(spark, sf_dir)
    return monitoring.block_accuracy(rows, 100, "predicted_at", "uuid")


@query
def accuracy_drift(spark, sf_dir):
    return monitoring.accuracy_drift(block_accuracy(spark, sf_dir))


@query
def string_index(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, *BLOCK])
    indexed = features.frequency_index(df, BLOCK)
    return indexed.select(ID, *BLOCK, *[f"{c}_StringIndex" for c in BLOCK])


def _newest(spark: SparkSession, sf_dir: str, n: int, labelled: bool = False) -> DataFrame:
    """The newest interactions; the rest of the tables is read for these orders only."""
    orders = retail.read(spark, sf_dir, "orders")
    if labelled:
        orders = orders.where("o_orderstatus <> 'P'")  # what the mapping labels
    orders = ordering.latest_n(orders, n, "o_orderdate", "o_orderkey")
    columns = [ID, *FEATURES, "conversion", "batch_tms"]
    return interactions(spark, sf_dir, columns, orders, few=True)


@query
def latest_n(spark, sf_dir):
    return _newest(spark, sf_dir, 1000)


@query
def latest_n_train(spark, sf_dir):
    return projection.as_label(_newest(spark, sf_dir, TRAIN_ROWS, labelled=True))


# --- sampling ----------------------------------------------------------------


@query
def hash_split(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, "recency", "history", "conversion"])
    return sampling.with_split(df, ID)


@query
def sample_n(spark, sf_dir):
    orders = sampling.sample_n(retail.read(spark, sf_dir, "orders"), 1000, "o_orderkey")
    return interactions(spark, sf_dir, [ID, *FEATURES], orders, few=True)


@query
def undersample(spark, sf_dir):
    df = projection.as_label(interactions(spark, sf_dir, [ID, "recency", "history", "conversion"]))
    return sampling.undersample(projection.labelled(df), 50, ID)


@query
def fold_assign(spark, sf_dir):
    return sampling.fold_assign(interactions(spark, sf_dir, [ID, "conversion"]), ID)


SMOTE = {
    "id_col": ID,
    "features": ["recency", "history"],
    "interpolate": ["recency", "history", "score"],
    "block": BLOCK,
    "k": 5,
}


@query
def smote(spark, sf_dir):
    rows = materialize(projection.labelled(_minority(spark, sf_dir, "score")))
    new = oversampling.synthetic_rows(rows, **SMOTE, percentage_over=200)
    return _rounded(new, "recency", "history", "score")


@query
def smote_union(spark, sf_dir):
    rows = materialize(projection.labelled(_minority(spark, sf_dir, "score")))
    balanced = oversampling.smote(rows, **SMOTE, percentage_over=200, percentage_under=50)
    return _rounded(balanced, "recency", "history", "score")


@query
def smote_vector(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, *BLOCK, *NUMERIC, "conversion"])
    scaled, _ = features.feature_pipeline(df, BLOCK, NUMERIC)
    new = oversampling.synthetic_vectors(scaled, ID, "scaledFeatures", 5, label="conversion")
    new = new.withColumn("v", vector_to_array("scaledFeatures"))
    last = F.size("v") - len(NUMERIC)  # the one-hot slots come first
    values = [F.round(F.col("v")[last + i], 6).alias(f"{c}_scaled") for i, c in enumerate(NUMERIC)]
    return new.select(ID, "copy", "neighbour_id", *values, "conversion")


# --- scalar functions --------------------------------------------------------


@query
def ts_suffix(spark, sf_dir):
    events = retail.read(spark, sf_dir, "events")
    return events.select("event_id", timestamps.time_suffix(F.col("ts")).alias("suffix"))


@query
def ts_parse(spark, sf_dir):
    entries = retail.registry_rows(spark, sf_dir)
    moment = paths.last_segment(F.col("location"))
    parsed = timestamps.parse_iso(moment)
    name = F.concat(F.lit("bestModel_"), timestamps.time_suffix(parsed))
    return entries.select(
        "run_id",
        parsed.alias("from_iso"),
        timestamps.parse_suffix(name).alias("from_suffix"),
        timestamps.parse_iso(F.col("name")).alias("from_other_text"),
    )


@query
def metric_times(spark, sf_dir):
    metrics = retail.metric_events(spark, sf_dir).drop("metrics")
    return monitoring.with_metric_times(metrics)


@query
def epoch_ms(spark, sf_dir):
    events = retail.read(spark, sf_dir, "events")
    return events.select("event_id", timestamps.epoch_ms(F.col("ts")).alias("ts_ms"))


@query
def path_parts(spark, sf_dir):
    path, uid = F.col("location"), paths.strip_uid(F.col("object_id"))
    return retail.registry_rows(spark, sf_dir).select(
        "run_id",
        paths.path_part(path, 1).alias("root"),
        paths.path_part(path, 3).alias("folder"),
        paths.last_segment(path).alias("leaf"),
        paths.path_part(path, 9).alias("missing"),
        paths.uid_name(uid).alias("uid_name"),
        paths.uid_code(uid).alias("uid_code"),
        paths.artifact_path("store/models/", timestamps.time_suffix(F.col("training_time"))).alias(
            "artifact_path"
        ),
    )


@query
def uid_strip(spark, sf_dir):
    entries = retail.registry_rows(spark, sf_dir)
    return entries.select("run_id", paths.strip_uid(F.col("object_id")).alias("uid"))


@query
def hash_uniform(spark, sf_dir):
    orders = retail.read(spark, sf_dir, "orders")
    u = hashing.hash_uniform("demo", "o_orderkey", "o_custkey")
    return orders.select("o_orderkey", F.round(u, 9).alias("u"))


@query
def threshold_label(spark, sf_dir):
    rows = retail.predictions(spark, sf_dir).drop("response_label")
    return monitoring.threshold_label(rows, "conversion_probability")


@query
def json_field(spark, sf_dir):
    return retail.read(spark, sf_dir, "events").select(
        "event_id",
        F.get_json_object("props", "$.k").alias("k_text"),
        F.from_json("props", T.StructType([T.StructField("k", T.LongType())]))["k"].alias("k"),
    )


# --- features and models -----------------------------------------------------


@query
def one_hot(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, "channel"])
    indexed = features.indexer(["channel"]).fit(df).transform(df)
    encoder = features.encoder(["channel"]).fit(indexed)
    values = encoder.transform(indexed).withColumn("v", vector_to_array("channel_ClassVect"))
    width = encoder.categorySizes[0] - 1  # the last one, of unseen categories, is dropped
    return values.select(ID, "channel", *[F.col("v")[i].alias(f"c{i}") for i in range(width)])


@query
def standard_scale(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, "recency", "history", "score"])
    scaled = features.standard_scale(df, ["recency", "history", "score"])
    return _rounded(scaled, "recency_scaled", "history_scaled", "score_scaled")


@query
def feature_pipeline(spark, sf_dir):
    df = interactions(spark, sf_dir, [ID, *BLOCK, *NUMERIC])
    out, _ = features.feature_pipeline(df, BLOCK, NUMERIC)
    values = out.withColumn("v", vector_to_array("scaledFeatures"))
    values = values.withColumn("slots", vector_to_array("features"))
    first = F.size("v") - len(NUMERIC)  # the one-hot slots come first
    return values.select(
        ID,
        F.size("v").alias("width"),
        F.array_join(
            F.transform(F.slice("slots", F.lit(1), first), lambda x: x.cast("int").cast("string")),
            "",
        ).alias("one_hot"),
        *[F.round(F.col("v")[first + i], 6).alias(f"{c}_scaled") for i, c in enumerate(NUMERIC)],
    )


def _model_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every labelled interaction with its features."""
    rows = projection.as_label(interactions(spark, sf_dir, [ID, *FEATURES, "conversion"]))
    return training.training_rows(projection.labelled(rows), ID)


def _split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return sampling.hash_split(_model_rows(spark, sf_dir), ID)


def _judged(predictions: DataFrame) -> DataFrame:
    """What is determined about a model's output: its rows, their form, and a least quality."""
    rows = materialize(predictions)
    auc = evaluation.auc_score(rows).first()["auc_score"]
    return rows.groupBy("label").agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("prediction").isin(0, 1)).alias("valid_predictions"),
        F.count_if(F.col("score").between(0, 1)).alias("valid_scores"),
        F.lit(auc is not None and auc > LEAST_AUC).alias("tells_apart"),
    )


@query
def train_rf(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = training.fit_pipeline(train, training.random_forest(), ID)
    return _judged(training.holdout_predictions(model, test, ID))


@query
def train_gbt(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = training.fit_pipeline(train, training.boosted_trees(), ID)
    return _judged(training.holdout_predictions(model, test, ID))


@query
def train_gbt_oversampled(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    model = training.fit_oversampled(train, training.boosted_trees(), ID)
    return _judged(training.holdout_predictions(model, test, ID))


@query
def train_rf_serving(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    return _judged(training.holdout_predictions(training.fit_serving_model(train), test, ID))


def _grid_rows(spark: SparkSession, found) -> DataFrame:
    """Grid points with their parameters and whether their metric is better than chance."""
    rows = training.grid_results(spark, found)
    names = sorted({p.name for point in found.getEstimatorParamMaps() for p in point})
    values = [F.col("params")[n].cast("int").alias(n) for n in names]
    return rows.select("point", *values, F.col("avg_metric").between(0.5, 1).alias("valid_metric"))


@query
def cv_grid(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    forest = training.random_forest()
    _, found = training.cross_validate(train, forest, training.FOREST_GRID, ID)
    return _grid_rows(spark, found)


@query
def cv_grid_boosted(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    _, found = training.cross_validate(
        train,
        training.boosted_trees(),
        training.BOOSTED_GRID,
        ID,
        metric="accuracy",
        rebalance=lambda rows: training.rebalanced(rows, ID),
    )
    return _grid_rows(spark, found)


@query
def holdout_predictions(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    forest = training.random_forest()
    model, _ = training.cross_validate(train, forest, training.FOREST_GRID, ID)
    return _judged(training.holdout_predictions(model, test, ID))


def _with_registry(spark: SparkSession, use: Callable[[str, str], DataFrame]) -> DataFrame:
    root = new_path(spark, "models")
    table = _table_name("registry", root)
    registry.ensure_registry(spark, table, f"{root}/registry")
    try:
        return use(table, root)
    finally:
        spark.sql(f"DROP TABLE {table}")


@query
def score_batch(spark, sf_dir):
    """The newest registered model scores the newest rows into the prediction table."""
    model = training.fit_pipeline(_model_rows(spark, sf_dir), training.random_forest(), ID)

    def use(table: str, root: str) -> DataFrame:
        registry.save_ml(spark, model, "spark_model", root, table, "run-1", STAMP)
        scores = table.replace("registry", "predictions")
        tables.ensure_table(spark, scores, tables.PREDICTIONS, location=f"{root}/predictions")
        try:
            newest = _newest(spark, sf_dir, 1000)
            scoring.score_into(newest, registry.load_model(spark, table), scores)
            return materialize(spark.table(scores))
        finally:
            spark.sql(f"DROP TABLE {scores}")

    stored = _with_registry(spark, use)
    return stored.select(
        *[F.round(F.col(c).cast("double"), 4).alias(c) if c == "score" else c for c in FEATURES],
        "label",
        *[f"{c}_StringIndex" for c in BLOCK],
        F.col("prediction").isin(0.0, 1.0).alias("valid_prediction"),
    )


@query
def score_requests(spark, sf_dir):
    model = training.fit_serving_model(_model_rows(spark, sf_dir))
    scored = scoring.score_requests(retail.requests(spark, sf_dir), model)
    return scored.select(
        "request_id",
        "error",
        F.col("prediction").isin(0.0, 1.0).alias("valid_prediction"),
        F.col("conversion_probability").between(0, 1).alias("valid_probability"),
    )


def _disagreements(first: DataFrame, second: DataFrame, columns: list[str]) -> DataFrame:
    """Number of rows of ``first`` and of rows that only one of the two has."""
    first, second = materialize(first.select(columns)), materialize(second.select(columns))
    odd = first.exceptAll(second).count() + second.exceptAll(first).count()
    return first.agg(F.count("*").alias("rows"), F.lit(odd).alias("disagreements"))


@query
def ml_save_load(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    fitted = training.fit_pipeline(train, training.random_forest(), ID)

    def use(table: str, root: str) -> DataFrame:
        registry.save_ml(spark, fitted, "spark_model", root, table, "run-1", STAMP)
        loaded = registry.load_model(spark, table)
        made = [training.holdout_predictions(m, test, ID) for m in (fitted, loaded)]
        return _disagreements(*made, [ID, "label", "prediction", "score"])

    return _with_registry(spark, use)


@query
def retrain(spark, sf_dir):
    """Registry after a retraining, with the number of rows that the new model scored."""
    columns = [ID, *FEATURES, "conversion", "batch_tms"]
    sample = interactions(spark, sf_dir, columns)
    sample = projection.as_label(projection.select_features(sample, [ID, *FEATURES]))
    orders = retail.read(spark, sf_dir, "orders")
    # The orders alone tell which interactions are the newest that have a label.
    found = {
        ID: F.col("o_orderkey"),
        "batch_tms": F.col("o_orderdate"),
        "conversion": F.when(F.col("o_orderstatus") != "P", 0),
    }

    def complete(newest: DataFrame) -> DataFrame:
        return interactions(spark, sf_dir, columns, newest.select(orders.columns), few=True)

    unfitted = training.make_pipeline(sample, training.random_forest(), ID)

    def use(table: str, root: str) -> DataFrame:
        registry.save_ml(spark, unfitted, "spark_pipeline", root, table, "run-1", STAMP)
        later = STAMP + dt.timedelta(hours=1)
        rows = orders.withColumns(found)
        scoring.retrain(
            spark, rows, table, root, "run-2", n=20_000, now=later, complete=complete
        )
        model = registry.load_model(spark, table)
        scored = scoring.score_batch(_newest(spark, sf_dir, 1000), model)
        entries = registry.registered(spark, table)
        entries = entries.select("object_kind", "run_id", "training_time")
        return materialize(entries.withColumn("scored", F.lit(scored.count())))

    return _with_registry(spark, use)


# --- monitoring --------------------------------------------------------------


@query
def metric_series(spark, sf_dir):
    metrics = metrics_flatten(spark, sf_dir)
    return monitoring.metric_series(metrics, "metrics_conversion_probability")


@query
def metric_series_accuracy(spark, sf_dir):
    return monitoring.metric_series(metrics_flatten(spark, sf_dir), "metrics_accuracy")


@query
def metric_series_processing_time(spark, sf_dir):
    timed = monitoring.with_metric_times(retail.metric_events(spark, sf_dir).drop("metrics"))
    return monitoring.metric_series(timed, "processing_micros")


@query
def metrics_tail_unpivot(spark, sf_dir):
    return monitoring.tail_transposed(metrics_flatten(spark, sf_dir))


# --- streams -----------------------------------------------------------------


def _into_table(
    spark: SparkSession, out: str, schema: T.StructType, job: Callable[[str], None]
) -> DataFrame:
    """What ``job`` wrote to a new stream table, read back through the catalog."""
    table = _table_name("stream", out)
    tables.ensure_stream_table(spark, table, schema, f"{out}/rows")
    try:
        job(table)
        return materialize(spark.table(table).drop(*tables.ORIGIN))
    finally:
        spark.sql(f"DROP TABLE {table}")


@query
def stream_ingest(spark, sf_dir):
    out = new_path(spark, "stream-ingest")
    orders = retail.read_stream(spark, sf_dir, "orders")

    def prepare(batch: DataFrame) -> DataFrame:
        return interactions(spark, sf_dir, [ID, *FEATURES, "conversion"], batch, restrict=True)

    rows = prepare(retail.read(spark, sf_dir, "orders"))
    schema = projection.ingest_batch(rows, F.lit(""), _stamp()).schema

    def job(table: str) -> None:
        jobs.ingest(orders, table, f"{out}/state", "stream", _stamp(), prepare)

    return _into_table(spark, out, schema, job)


@query
def stream_score(spark, sf_dir):
    model = training.fit_pipeline(_model_rows(spark, sf_dir), training.random_forest(), ID)
    out = new_path(spark, "stream-score")
    orders = retail.read_stream(spark, sf_dir, "orders")
    columns = [ID, *FEATURES, "conversion"]

    def prepare(batch: DataFrame) -> DataFrame:
        return projection.as_label(interactions(spark, sf_dir, columns, batch, restrict=True))

    def use(registered: str, root: str) -> DataFrame:
        registry.save_ml(spark, model, "spark_model", root, registered, "run-1", STAMP)
        newest = registry.newest_model(spark, registered)
        select = scoring.prediction_columns

        def job(table: str) -> None:
            jobs.score(orders, table, f"{out}/state", "scores", newest, select, prepare)

        schema = select(model.transform(prepare(retail.read(spark, sf_dir, "orders")))).schema
        return _into_table(spark, out, schema, job)

    streamed = _with_registry(spark, use)
    batch = projection.as_label(interactions(spark, sf_dir, [ID, *FEATURES, "conversion"]))
    batch = scoring.prediction_columns(model.transform(batch))
    return _disagreements(batch, streamed, scoring.PREDICTION_COLUMNS)


@query
def stream_delayed_labels(spark, sf_dir):
    out = new_path(spark, "stream-labels")
    predictions = retail.prediction_rows(retail.read_stream(spark, sf_dir, "events"))
    truth = retail.truth_rows(retail.read_stream(spark, sf_dir, "events"))
    jobs.delayed_labels(
        predictions, truth, f"{out}/rows", f"{out}/state", lateness="10 minutes", within="1 hour"
    )
    return spark.read.parquet(f"{out}/rows")


def _labelled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled responses as a stream, the outcome read off the same event."""
    events = retail.read_stream(spark, sf_dir, "events")
    outcome = (F.col("event_type") == "purchase").cast("int").alias("final_label")
    return retail.prediction_rows(events, outcome)


@query
def stream_accuracy(spark, sf_dir):
    out = new_path(spark, "stream-accuracy")
    rows = _labelled_stream(spark, sf_dir)
    jobs.windowed_accuracy(
        rows, f"{out}/rows", f"{out}/state", window="1 day", lateness="1 hour"
    )
    return spark.read.parquet(f"{out}/rows")


@query
def stream_block_accuracy(spark, sf_dir):
    out = new_path(spark, "stream-blocks")
    rows = _labelled_stream(spark, sf_dir)
    jobs.count_blocks(rows, f"{out}/rows", f"{out}/state", 100, lateness="1 day")
    return jobs.counted_blocks(spark, f"{out}/rows", 100, waiting=True)
