"""What the corpus operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of all word rules here: space and the bytes 9 to 13.
SPACE = r"\x20\x09-\x0D"
#: Rows of one Arrow batch; ten thousand long texts would not fit a worker.
BATCH_ROWS = 1000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts within a Python worker's memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > BATCH_ROWS or int(spark.conf.get(name)) <= 0:
        spark.conf.set(name, BATCH_ROWS)


def keeps_names(function):
    """For ``function(docs, …)`` that returns the columns of ``docs``: any may be called ``__x``.

    Operators call columns of their own so. Such columns of ``docs`` bear other
    names meanwhile; only the key and the text cannot be called so.
    """
    signature = inspect.signature(function)

    @functools.wraps(function)
    def run(docs: DataFrame, *args, **kwargs) -> DataFrame:
        mark = uuid.uuid4().hex
        aside = {c: f"c{i}_{mark}" for i, c in enumerate(docs.columns) if c.startswith("__")}
        if not aside:
            return function(docs, *args, **kwargs)
        given = signature.bind(docs, *args, **kwargs)
        given.apply_defaults()
        for name in ("key", "text"):
            if given.arguments.get(name) in aside:
                raise ValueError(f"{name} column begins with two underscores")
        made = function(docs.withColumnsRenamed(aside), *args, **kwargs)
        return made.withColumnsRenamed({new: old for old, new in aside.items()})

    return run


def tidy(run):
    """``run`` over the batches of a task, with its memory given back at the end.

    Python workers outlive tasks, and what the allocators keep of one stage's
    arrays would add to what the next stage needs.
    """

    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task
