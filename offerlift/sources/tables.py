"""Catalog tables: creation, appends by column name, micro-batches, snapshots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The table definition of customer interactions: a key, and a partition column
# that lets "newest rows" queries skip older months.
INTERACTIONS = T.StructType(
    [
        T.StructField("interaction_id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("street_address", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("postcode", T.IntegerType()),
        T.StructField("phone_number", T.IntegerType()),
        T.StructField("job", T.StringType()),
        T.StructField("recency", T.IntegerType()),
        T.StructField("history", T.IntegerType()),
        T.StructField("used_discount", T.IntegerType()),
        T.StructField("used_bogo", T.IntegerType()),
        T.StructField("zip_code", T.StringType()),
        T.StructField("is_referral", T.IntegerType()),
        T.StructField("channel", T.StringType()),
        T.StructField("offer", T.StringType()),
        T.StructField("conversion", T.IntegerType()),
        T.StructField("score", T.FloatType()),
        T.StructField("batch_id", T.StringType()),
        T.StructField("batch_tms", T.TimestampNTZType()),
        T.StructField("batch_month", T.DateType()),
    ]
)

# Scored rows. Categories stay text: they are names, not numbers.
PREDICTIONS = T.StructType(
    [
        *[
            T.StructField(c, T.FloatType())
            for c in ("recency", "history", "used_discount", "used_bogo")
        ],
        T.StructField("zip_code", T.StringType()),
        T.StructField("is_referral", T.FloatType()),
        T.StructField("channel", T.StringType()),
        T.StructField("offer", T.StringType()),
        *[
            T.StructField(c, T.FloatType())
            for c in (
                "score",
                "label",
                "zip_code_StringIndex",
                "channel_StringIndex",
                "offer_StringIndex",
                "prediction",
            )
        ],
    ]
)


def ensure_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    replace: bool = False,
    partition_by: Sequence[str] = (),
    location: str | None = None,
) -> None:
    """Create a Parquet table unless it exists; ``replace`` drops the old one first."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING PARQUET"
    if partition_by:
        ddl += f" PARTITIONED BY ({', '.join(partition_by)})"
    if location is not None:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


#: Where a row of a stream's table came from; its partitions.
ORIGIN = ["stream", "epoch"]


def ensure_stream_table(
    spark: SparkSession, name: str, schema: T.StructType, location: str | None = None
) -> None:
    """A table that streams write to, with a partition for each micro-batch of each stream."""
    origin = [T.StructField("stream", T.StringType()), T.StructField("epoch", T.LongType())]
    columns = T.StructType([*schema.fields, *origin])
    ensure_table(spark, name, columns, partition_by=ORIGIN, location=location)


def _aligned(df: DataFrame, table: str, leave_out: Sequence[str] = ()) -> DataFrame:
    """``df`` with the table's columns, in its order and types, but for ``leave_out``."""
    target = df.sparkSession.table(table).drop(*leave_out).schema
    present = {c.lower() for c in df.columns}
    if unknown := present - {f.name.lower() for f in target.fields}:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")

    def value(name: str) -> Column:
        return F.col(name) if name.lower() in present else F.lit(None)

    return df.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in target.fields])


def append(df: DataFrame, table: str) -> None:
    """Append by column name; columns the frame lacks become null.

    A column that the table does not have is an error, not a loss.
    """
    aligned = _aligned(df, table)
    partitions = [c.name for c in df.sparkSession.catalog.listColumns(table) if c.isPartition]
    writer = aligned.write.mode("append").format("parquet")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.saveAsTable(table)


def replace_epoch(df: DataFrame, table: str, stream: str, epoch: int) -> None:
    """Make ``df`` all that the table holds of one micro-batch of ``stream``.

    What an earlier attempt at the micro-batch left is replaced, also by no rows;
    other micro-batches and streams are not touched. Columns are as in ``append``.
    """
    if not re.fullmatch(r"[\w.-]+", stream):
        raise ValueError(f"not a name for a stream: {stream!r}")
    df.sparkSession.sql(
        f"INSERT OVERWRITE TABLE {table} PARTITION (stream = '{stream}', epoch = {int(epoch)})"
        " SELECT * FROM {rows}",
        rows=_aligned(df, table, ORIGIN),
    )


def write_if_absent(df: DataFrame, table: str, location: str | None = None) -> None:
    """Save a snapshot; a table that exists already is left as it is."""
    writer = df.write.mode("ignore").format("parquet")
    if location is not None:
        writer = writer.option("path", location)
    writer.saveAsTable(table)
