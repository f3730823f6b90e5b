"""The shared folder: checkpoints, written tables, stream state.

It is the folder named by ``spark.checkpoint.dir``, or the one set on the Spark
context. A session with neither has no place that its executors share, and is
refused; ``provide_folder`` gives a plain local session one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def shared_folder(spark: SparkSession) -> str:
    folder = _configured(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def provide_folder(spark: SparkSession) -> None:
    """Give a session of one local process a temporary folder if none is set."""
    master = spark.sparkContext.master
    one_process = master == "local" or master.startswith("local[")
    if _configured(spark) is None and one_process:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="offerlift-"))


def new_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one run; nothing is ever written over."""
    return f"{shared_folder(spark).rstrip('/')}/offerlift/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str = "step") -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Lineage is cut as by a checkpoint, and what follows can still prune columns
    and push filters down.
    """
    spark = df.sparkSession
    path = new_path(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
