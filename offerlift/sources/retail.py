"""Campaign tables derived from the retail star schema and the event log.

The derivation rules are those of FIXTURES.md. ``interactions`` joins only what
the requested columns need, so a projection over ``orders`` alone never reads
``lineitem``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlift.functions.hashing import hash_uniform
from offerlift.functions.timestamps import epoch_micros, epoch_ms, iso_text, time_suffix

FEATURES = [
    "recency",
    "history",
    "used_discount",
    "used_bogo",
    "zip_code",
    "is_referral",
    "channel",
    "offer",
    "score",
]
TARGET = "conversion"
BLOCK = ["zip_code", "channel", "offer"]

INTERACTION_COLUMNS = [
    "interaction_id",
    "name",
    "street_address",
    "city",
    "postcode",
    "phone_number",
    "job",
    "recency",
    "history",
    "used_discount",
    "used_bogo",
    "zip_code",
    "is_referral",
    "channel",
    "offer",
    "conversion",
    "score",
    "batch_id",
    "batch_tms",
]

_FROM_REGION = {"zip_code"}
_FROM_NATION = {"city"} | _FROM_REGION
_FROM_CUSTOMER = {"name", "channel"} | _FROM_NATION
_FROM_LINES = {"used_discount", "used_bogo", "conversion"}


# Naming the schema spares a job per scan that would read it from a file.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_quantity double, l_discount double",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,"
    " value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def read_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    reader = spark.readStream.schema(SCHEMAS[table]).option("pathGlobFilter", f"{table}.parquet")
    return reader.parquet(sf_dir)


def _customers(spark: SparkSession, sf_dir: str, wanted: set[str]) -> DataFrame:
    customers = read(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("channel"),
        F.col("c_nationkey").alias("n_nationkey"),
    )
    if wanted & _FROM_NATION:
        nations = read(spark, sf_dir, "nation")
        customers = customers.join(
            nations.select("n_nationkey", F.col("n_name").alias("city"), "n_regionkey"),
            "n_nationkey",
        )
    if wanted & _FROM_REGION:
        regions = read(spark, sf_dir, "region")
        customers = customers.join(
            regions.select(
                F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("zip_code")
            ),
            "n_regionkey",
        )
    return customers


def _line_flags(spark: SparkSession, sf_dir: str, only: DataFrame | None = None) -> DataFrame:
    lines = read(spark, sf_dir, "lineitem")
    if only is not None:
        keys = only.select(F.col("o_orderkey").alias("l_orderkey"))
        lines = lines.join(keys, "l_orderkey", "left_semi")
    return (
        lines.groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(
            F.max((F.col("l_discount") >= 0.09).cast("int")).alias("any_discount"),
            F.max((F.col("l_quantity") >= 48).cast("int")).alias("any_bogo"),
        )
    )


def interactions(
    spark: SparkSession,
    sf_dir: str,
    columns: Sequence[str] | None = None,
    orders: DataFrame | None = None,
    few: bool = False,
    restrict: bool = False,
) -> DataFrame:
    """Customer interactions with marketing offers, one row per order.

    ``orders`` may be a stream of orders; the other tables are static. If
    ``orders`` is part of all orders, ``restrict`` aggregates only their lines;
    if it is a bounded number of rows, ``few`` also sends their keys to the scan.
    """
    columns = list(columns or INTERACTION_COLUMNS)
    wanted = set(columns)
    rows = read(spark, sf_dir, "orders") if orders is None else orders
    if wanted & _FROM_LINES:
        only = F.broadcast(rows) if few else rows if restrict else None
        rows = rows.join(_line_flags(spark, sf_dir, only), "o_orderkey", "left")
    else:
        rows = rows.withColumns({"any_discount": F.lit(0), "any_bogo": F.lit(0)})
    if wanted & _FROM_CUSTOMER:
        rows = rows.join(_customers(spark, sf_dir, wanted), "o_custkey")
    history = F.floor(F.col("o_totalprice") / 1000).cast("int")
    used_discount = F.coalesce("any_discount", F.lit(0))
    response_rate = (
        F.lit(0.05) + F.lit(0.25) * used_discount + F.lit(0.15) * (history >= 250).cast("int")
    )
    derived = {
        "interaction_id": F.col("o_orderkey"),
        "street_address": F.lit(None).cast("string"),
        "postcode": F.lit(None).cast("int"),
        "phone_number": F.lit(None).cast("int"),
        "job": F.lit(None).cast("string"),
        "recency": F.expr("datediff(date'2002-01-01', to_date(o_orderdate)) div 30").cast("int"),
        "history": history,
        "used_discount": used_discount,
        "used_bogo": F.coalesce("any_bogo", F.lit(0)),
        "is_referral": (F.col("o_custkey") % 2).cast("int"),
        "offer": F.col("o_orderpriority"),
        "score": F.round(hash_uniform("s", "o_orderkey"), 6),
        # Constant branches let Catalyst reduce "label is known" to the order status.
        "conversion": F.when(
            F.col("o_orderstatus") != "P",
            F.when(hash_uniform("y", "o_orderkey") < response_rate, 1).otherwise(0),
        ),
        "batch_id": F.md5(F.translate(F.left(iso_text(F.col("o_orderdate")), F.lit(7)), "-", "")),
        "batch_tms": F.col("o_orderdate").cast("timestamp_ntz"),
    }
    return rows.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in columns])


def scored(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    """Labelled interactions with their score and the 0.5-threshold prediction."""
    wanted = dict.fromkeys(["interaction_id", "conversion", "score", *extra])
    return (
        interactions(spark, sf_dir, list(wanted))
        .where(F.col("conversion").isNotNull())
        .withColumnRenamed("conversion", "label")
        .withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    )


def _probability() -> Column:
    return F.round(F.col("value") / (F.col("value") + 25.0), 6)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model response per event."""
    return prediction_rows(read(spark, sf_dir, "events"))


def prediction_rows(events: DataFrame, *extra: Column) -> DataFrame:
    return events.select(
        F.col("event_id").cast("string").alias("uuid"),
        F.concat(F.lit("model-"), (F.col("user_id") % 3).cast("string")).alias("model_id"),
        F.col("ts").alias("predicted_at"),
        _probability().alias("conversion_probability"),
        (_probability() >= 0.5).cast("int").alias("response_label"),
        *extra,
    )


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes, known five minutes after the response. Errors have none."""
    return truth_rows(read(spark, sf_dir, "events"))


def truth_rows(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") != "error").select(
        F.col("event_id").cast("string").alias("uuid"),
        F.expr("ts + interval 5 minutes").alias("labelled_at"),
        (F.col("event_type") == "purchase").cast("int").alias("final_label"),
    )


def metric_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw metric records: identifiers, epoch-ms times and a JSON metrics object."""
    micros = epoch_micros(F.col("ts"))
    metrics = F.struct(
        F.when(F.col("event_type") != "error", (_probability() >= 0.5).cast("int")).alias(
            "prediction"
        ),
        F.when(F.col("event_type") != "error", _probability()).alias("conversion_probability"),
        F.when(
            F.col("event_type").isin("purchase", "click"),
            (F.col("event_type") == "purchase").cast("int"),
        ).alias("final_label"),
        F.when(F.col("event_id") % 100 == 99, F.round(F.col("value") / 1000, 6)).alias("accuracy"),
    )
    return read(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("uuid"),
        epoch_ms(F.col("ts")).alias("startTimeStampMs"),
        F.floor((micros + F.round(F.col("value") * 1000).cast("bigint")) / 1000)
        .cast("bigint")
        .alias("endTimeStampMs"),
        F.to_json(metrics).alias("metrics"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests as JSON text, with field names in three spellings.

    One body in 97 is cut off, as by a broken connection.
    """
    fields = ["recency", "history", "used_discount", "used_bogo", "is_referral", "score"]
    rows = interactions(spark, sf_dir, ["interaction_id", *fields])
    number = F.col("interaction_id")

    def body(spell) -> Column:
        return F.to_json(F.struct(*[F.col(c).alias(spell(c)) for c in fields]))

    spelt = F.when(number % 3 == 0, body(str.upper)).when(number % 3 == 1, body(str.lower))
    spelt = spelt.otherwise(body(str.title))
    return rows.select(
        number.cast("string").alias("request_id"),
        F.when(number % 97 == 0, F.substring(spelt, 1, 30)).otherwise(spelt).alias("body"),
    )


def _truncated(unit: str) -> Column:
    day = F.to_date("ts")
    hour = F.hour("ts") if unit == "hour" else F.lit(0)
    return day.cast("timestamp_ntz") + F.make_dt_interval(hours=hour)


def registry_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model registry with one training run per event.

    Times tie (they are cut to the hour) and every third location carries no
    fraction, the two cases that break a lookup by text.
    """
    kind = (
        F.when(F.col("event_type") == "purchase", "spark_model")
        .when(F.col("event_type") == "signup", "spark_pipeline")
        .otherwise("sklearn_model")
    )
    event = F.col("event_id").cast("string")
    name = F.when(kind == "spark_pipeline", "Pipeline").otherwise("PipelineModel")
    ts = F.col("ts")
    iso = F.when(F.col("event_id") % 3 == 0, iso_text(ts)).otherwise(iso_text(ts, fraction=True))
    return read(spark, sf_dir, "events").select(
        kind.alias("object_kind"),
        name.alias("name"),
        F.concat(F.lit("uid="), name, F.lit("_"), F.substring(F.md5(event), 1, 12)).alias(
            "object_id"
        ),
        _truncated("hour").alias("training_time"),
        F.concat(F.lit("store/campaign/"), kind, F.lit("/"), iso).alias("location"),
        F.concat(F.lit("run-"), event).alias("run_id"),
    )


def lineage_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model lineage: each event's model was trained on one or two tables."""
    tables = F.when(
        F.col("event_type").isin("purchase", "signup"),
        F.array(F.lit("default.customer_interactions"), F.lit("default.labels")),
    ).otherwise(F.array(F.lit("default.customer_interactions")))
    return read(spark, sf_dir, "events").select(
        F.concat(F.lit("classifier "), time_suffix(F.col("ts"))).alias("model_name"),
        tables.alias("tables"),
        F.create_map(F.lit("trigger"), F.col("event_type")).alias("metadata"),
    )


def artifact_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact folder names, the creation time in their last 14 characters."""
    stem = F.when(F.col("event_type") == "signup", "pipeline").otherwise("bestModel")
    return read(spark, sf_dir, "events").select(
        F.concat(stem, F.lit("_"), time_suffix(_truncated("day"))).alias("artifact")
    )
