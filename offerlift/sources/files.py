"""CSV files and model artifacts in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.functions.timestamps import parse_suffix


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """CSV with a header: typed by ``schema``, inferred, or all text.

    Inference reads the files once more, so name a schema for large inputs.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def restamp_csv(spark: SparkSession, path: str, out: str, stamp) -> None:
    """Read a CSV file, apply ``stamp`` and write the result to a new path."""
    stamp(read_csv(spark, path)).write.option("header", True).csv(out)


def list_artifacts(spark: SparkSession, root: str) -> DataFrame:
    """Names of what lies right below ``root``; the folders themselves are not opened.

    One listing of one level, however many files the artifacts have. As in Spark's
    own listings, names that start with a dot or, without ``=``, an underscore are
    hidden. What comes to the driver is one name per artifact.
    """
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    names = [path.getName() for path in jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(found)]
    shown = [
        (n,) for n in names if not (n.startswith(".") or (n.startswith("_") and "=" not in n))
    ]
    return spark.createDataFrame(shown, "artifact string")


def latest_artifact(artifacts: DataFrame, kind: str, name: str = "artifact") -> DataFrame:
    """The newest artifacts of a kind, by the time in the last 14 characters.

    Several may share the newest time; names without a time never win.
    """
    timed = artifacts.where(F.col(name).contains(kind)).withColumn(
        "created_at", parse_suffix(F.col(name))
    )
    newest = timed.agg(F.max("created_at").alias("created_at"))
    return timed.join(F.broadcast(newest), "created_at").select(name, "created_at")  # one row
