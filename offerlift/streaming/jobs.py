"""Structured Streaming twins of the batch jobs.

Every job reads what is available and stops (``availableNow``), so a scheduler
can run it as often as it likes; state and progress live in ``state``. Jobs
that write from ``foreachBatch`` replace a micro-batch's own partition of their
table, or its own folder, which makes a replayed batch harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.functions.timestamps import epoch_micros, from_epoch_micros
from offerlift.operators.monitoring import block_parts, full_blocks
from offerlift.operators.ordering import with_row_index
from offerlift.operators.projection import ingest_batch
from offerlift.sources.tables import replace_epoch


def _each_batch(stream: DataFrame, state: str, handle: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _append_to(stream: DataFrame, path: str, state: str) -> None:
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks take ``timestamp`` only; wall clocks are read as UTC for them."""
    return df.withColumn(column, F.timestamp_micros(epoch_micros(F.col(column))))


def _wall_clock(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: from_epoch_micros(F.unix_micros(F.col(c))) for c in columns})


def _write_batch(batch: DataFrame, path: str, epoch: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def ingest(
    stream: DataFrame,
    table: str,
    state: str,
    name: str,
    batch_tms: Column | None = None,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Arriving interactions, outcome unknown, into a table made by ``ensure_stream_table``.

    Each micro-batch has a batch id of its own, the stream's ``name`` and a number.
    Streams that share a table need different names. ``prepare`` makes interactions of a micro-batch, so that what it joins can be
    restricted to the batch's keys.
    """

    def handle(batch: DataFrame, epoch: int) -> None:
        rows = ingest_batch(prepare(batch), F.lit(f"{name}-{epoch}"), batch_tms)
        replace_epoch(rows, table, name, epoch)

    _each_batch(stream, state, handle)


def score(
    stream: DataFrame,
    table: str,
    state: str,
    name: str,
    model: Callable[[], PipelineModel],
    select: Callable[[DataFrame], DataFrame],
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> None:
    """Predictions for arriving interactions, into a table as in ``ingest``.

    ``model``, such as ``registry.newest_model``, is asked once per micro-batch, so
    a retrained model takes over without a restart. ``name`` and ``prepare`` are as
    in ``ingest``.
    """

    def handle(batch: DataFrame, epoch: int) -> None:
        replace_epoch(select(model().transform(prepare(batch))), table, name, epoch)

    _each_batch(stream, state, handle)


def delayed_labels(
    predictions: DataFrame,
    truth: DataFrame,
    path: str,
    state: str,
    *,
    lateness: str,
    within: str,
) -> None:
    """Predictions joined to the outcomes that arrive up to ``within`` later.

    The bound and the two watermarks let Spark drop state it cannot need; what
    comes later than they allow is lost, so there is no default for them.
    """
    p = _event_time(predictions, "predicted_at").withWatermark("predicted_at", lateness)
    t = _event_time(truth, "labelled_at").withWatermark("labelled_at", lateness)
    t = t.withColumnRenamed("uuid", "truth_uuid")
    joined = p.join(
        t,
        (F.col("uuid") == F.col("truth_uuid"))
        & (F.col("labelled_at") >= F.col("predicted_at"))
        & (F.col("labelled_at") <= F.col("predicted_at") + F.expr(f"interval {within}")),
    )
    matched = _wall_clock(joined.drop("truth_uuid"), "predicted_at", "labelled_at")
    _append_to(matched, path, state)


def windowed_accuracy(
    labelled: DataFrame,
    path: str,
    state: str,
    *,
    window: str,
    lateness: str,
    time_col: str = "predicted_at",
) -> None:
    """Accuracy per time window, written once the watermark has passed its end."""
    correct = (F.col("final_label") == F.col("response_label")).cast("int")
    windows = (
        _event_time(labelled, time_col)
        .withWatermark(time_col, lateness)
        .groupBy(F.window(time_col, window).alias("w"))
        .agg(F.count("*").alias("responses"), F.sum(correct).alias("correct"))
    )
    accuracy = windows.select(
        F.col("w.start").alias("started_at"),
        F.col("w.end").alias("ended_at"),
        "responses",
        F.round(F.col("correct") / F.col("responses"), 6).alias("accuracy"),
    )
    _append_to(_wall_clock(accuracy, "started_at", "ended_at"), path, state)


def count_blocks(
    labelled: DataFrame,
    path: str,
    state: str,
    n: int,
    model_col: str = "model_id",
    time_col: str = "predicted_at",
    key: str = "uuid",
    lateness: str | None = None,
) -> None:
    """Responses counted into blocks of ``n`` per model, in order of time.

    A response waits until no response more than ``lateness`` (such as ``1 hour``)
    younger than it has been seen still to come, that is until the newest time
    seen, less ``lateness``, has passed it; those that wait are written aside with
    each micro-batch. What arrives after its turn, or without a time, can have no
    place in the order: it is kept under ``late`` and not counted. With no
    ``lateness`` nothing waits and micro-batches follow each other as they arrive.

    A keyed state function would walk all responses of a model in one task.
    Instead each micro-batch is numbered in parallel, starting where the
    batches before it ended; what is kept between batches is one running count
    per model and what waits, and a block that spans batches is stored in parts.
    """
    spark = labelled.sparkSession
    columns = [model_col, time_col, key, "final_label", "response_label"]
    kinds = labelled.select(*columns).schema

    def kept(epoch: int, what: str, schema: T.StructType) -> DataFrame:
        """What the micro-batch before left; nothing before the first."""
        if epoch == 0:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(f"{path}/{what}/epoch={epoch - 1}")

    time_schema = T.StructType([kinds[time_col]])

    def in_turn(rows: DataFrame, epoch: int) -> tuple[DataFrame, DataFrame]:
        """The responses whose turn has come, and up to when; the others are written aside."""
        moment = F.col(time_col)
        passed = kept(epoch, "passed", time_schema).first()
        passed = F.lit(passed[0] if passed else None).cast(kinds[time_col].dataType)
        late = moment.isNull() | F.coalesce(moment < passed, F.lit(False))
        _write_batch(rows.where(late), f"{path}/late", epoch)
        open_ = rows.where(~late).unionByName(kept(epoch, "waiting", kinds))
        newest = open_.agg((F.max(moment) - F.expr(f"interval {lateness}")).alias(time_col))
        bound = newest.select(F.greatest(F.col(time_col), passed).alias(time_col)).first()[0]
        waits = moment >= F.lit(bound).cast(kinds[time_col].dataType)
        waits = F.coalesce(waits, F.lit(True))
        _write_batch(open_.where(waits), f"{path}/waiting", epoch)
        return open_.where(~waits), spark.createDataFrame([(bound,)], time_schema)

    counts_schema = T.StructType([kinds[model_col], T.StructField("responses", T.LongType())])

    def handle(batch: DataFrame, epoch: int) -> None:
        rows = batch.select(*columns)
        ready, passed = (rows, None) if lateness is None else in_turn(rows, epoch)
        before = kept(epoch, "counts", counts_schema)
        parts = _parts_after(ready, before, n, model_col, time_col, key)
        _write_batch(parts, f"{path}/parts", epoch)
        written = spark.read.parquet(f"{path}/parts/epoch={epoch}")
        counts = (
            written.select(model_col, "responses")
            .unionByName(before)
            .groupBy(model_col)
            .agg(F.sum("responses").alias("responses"))
        )
        _write_batch(counts, f"{path}/counts", epoch)
        if passed is not None:
            _write_batch(passed, f"{path}/passed", epoch)

    _each_batch(labelled, state, handle)


def _parts_after(
    rows: DataFrame, before: DataFrame, n: int, model_col: str, time_col: str, key: str
) -> DataFrame:
    """Block parts of ``rows``, numbered on from each model's count in ``before``."""
    indexed = with_row_index(rows, [time_col, key], [model_col])
    before = before.select(F.col(model_col).alias("__model"), "responses")
    position = F.coalesce("responses", F.lit(0)) + F.col("row_index") - 1
    placed = indexed.join(before, F.col(model_col).eqNullSafe(F.col("__model")), "left")
    placed = placed.withColumn("block", F.floor(position / n).cast("bigint"))
    return block_parts(placed, time_col, [model_col], "final_label", "response_label")


def counted_blocks(
    spark: SparkSession,
    path: str,
    n: int,
    model_col: str = "model_id",
    time_col: str = "predicted_at",
    key: str = "uuid",
    waiting: bool = False,
) -> DataFrame:
    """The full blocks stored by ``count_blocks``.

    With ``waiting``, as if the stream had ended: responses that still wait for
    their turn are counted as well.
    """
    parts = spark.read.parquet(f"{path}/parts")
    if waiting:
        # One row for each epoch, written last: the newest one is whole.
        last = spark.read.parquet(f"{path}/passed").agg(F.max("epoch")).first()[0]
        parts = parts.where(F.col("epoch") <= last)
        rows, before = (
            spark.read.parquet(f"{path}/{what}/epoch={last}") for what in ("waiting", "counts")
        )
        parts = parts.drop("epoch").unionByName(
            _parts_after(rows, before, n, model_col, time_col, key)
        )
    return full_blocks(parts, n, [model_col])
