"""Model registry, model lineage and saved Spark ML objects.

The registry table is a log that writers append to without a lock. Two writers
that register one run at the same time both find it missing and both add it;
``registered`` therefore gives the entry that was stamped first of each run, and
everything that reads a registry reads it that way.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.sources.tables import append, ensure_table

REGISTRY = T.StructType(
    [
        T.StructField("object_kind", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("object_id", T.StringType()),
        T.StructField("training_time", T.TimestampNTZType()),
        T.StructField("location", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)
#: An entry as stored, with what decides between two entries of one run.
LOG = T.StructType(
    [
        *REGISTRY.fields,
        T.StructField("registered_micros", T.LongType()),
        T.StructField("entry_id", T.StringType()),
    ]
)
LINEAGE = T.StructType(
    [
        T.StructField("model_name", T.StringType()),
        T.StructField("tables", T.ArrayType(T.StringType())),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)
RUN_KEY = ["object_kind", "run_id"]


def ensure_registry(spark: SparkSession, table: str, location: str | None = None) -> None:
    ensure_table(spark, table, LOG, location=location)


def new_entries(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """The entries of runs the registry does not hold yet, each run once."""
    fresh = entries.join(existing.select(*RUN_KEY), RUN_KEY, "left_anti")
    return fresh.dropDuplicates(RUN_KEY).select(entries.columns)


def register(entries: DataFrame, table: str) -> None:
    """Add the runs that the registry does not hold; safe with other writers at work."""
    fresh = new_entries(entries, entries.sparkSession.table(table))
    stamps = {"registered_micros": F.unix_micros(F.current_timestamp()), "entry_id": F.uuid()}
    append(fresh.withColumns(stamps), table)


def registered(spark: SparkSession, table: str) -> DataFrame:
    """One entry per run: the first by time of registration, then by entry id.

    Entries without a run id count as one run of their kind.
    """
    others = [c for c in REGISTRY.names if c not in RUN_KEY]
    first = F.min_by(F.struct(*others), F.struct("registered_micros", "entry_id"))
    runs = spark.table(table).groupBy(*RUN_KEY).agg(first.alias("e"))
    return runs.select(*RUN_KEY, "e.*").select(*REGISTRY.names)


def registry_entry(
    spark: SparkSession,
    kind: str,
    uid: str,
    training_time: dt.datetime,
    location: str,
    run_id: str,
) -> DataFrame:
    name, _, code = uid.partition("_")
    return spark.createDataFrame([(kind, name, code, training_time, location, run_id)], REGISTRY)


def latest(registry: DataFrame, kind: str | None = None) -> DataFrame:
    """The newest entry of each kind; of equal times the longer, then greater run id wins.

    So ``run-10`` comes after ``run-9``.
    """
    if kind is not None:
        registry = registry.where(F.col("object_kind") == kind)
    entry = F.struct("name", "object_id", "training_time", "location", "run_id")
    newest = F.max_by(entry, F.struct("training_time", F.length("run_id"), "run_id"))
    return registry.groupBy("object_kind").agg(newest.alias("e")).select("object_kind", "e.*")


def latest_location(registry: DataFrame, kind: str) -> str:
    row = latest(registry, kind).first()
    if row is None:
        raise LookupError(f"no {kind} is registered")
    return row["location"]


def save_ml(
    spark: SparkSession,
    stage,
    kind: str,
    root: str,
    table: str,
    run_id: str,
    now: dt.datetime | None = None,
) -> str:
    """Save a pipeline or model under its run and time suffix and register that exact path."""
    now = now or dt.datetime.now()
    location = f"{root.rstrip('/')}/{kind}/{run_id}/{now:%d%m%Y%H%M%S}"
    stage.write().save(location)
    register(registry_entry(spark, kind, stage.uid, now, location, run_id), table)
    return location


def load_model(spark: SparkSession, table: str, kind: str = "spark_model") -> PipelineModel:
    return PipelineModel.load(latest_location(registered(spark, table), kind))


def newest_model(
    spark: SparkSession, table: str, kind: str = "spark_model"
) -> Callable[[], PipelineModel]:
    """A function that gives the newest registered model, loaded again only when it changes."""
    held: dict[str, PipelineModel] = {}

    def model() -> PipelineModel:
        location = latest_location(registered(spark, table), kind)
        if location not in held:
            held.clear()
            held[location] = PipelineModel.load(location)
        return held[location]

    return model


def load_pipeline(spark: SparkSession, table: str, kind: str = "spark_pipeline") -> Pipeline:
    return Pipeline.load(latest_location(registered(spark, table), kind))


def record_lineage(
    spark: SparkSession,
    table: str,
    model_name: str,
    tables: Sequence[str],
    metadata: Mapping[str, str],
) -> None:
    row = [(model_name, list(tables), dict(metadata))]
    append(spark.createDataFrame(row, LINEAGE), table)


def lineage_edges(lineage: DataFrame) -> DataFrame:
    """One row per model and table it was trained on."""
    return lineage.select("model_name", F.explode("tables").alias("table_name"), "metadata")
