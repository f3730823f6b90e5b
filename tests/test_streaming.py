"""Streams against the batch operators on the same rows."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from offerlift.operators import projection
from offerlift.operators.monitoring import attach_labels, block_accuracy
from offerlift.plans import training
from offerlift.sources import retail, tables
from offerlift.sources.workspace import new_path
from offerlift.streaming import jobs

KEYS = ["uuid", "model_id", "predicted_at", "final_label", "response_label"]


def events_in_order(spark, sf_dir, parts):
    """The event log as several files, each newer than the one before."""
    path = new_path(spark, "events")
    events = retail.read(spark, sf_dir, "events")
    bounds = events.approxQuantile("event_id", [i / parts for i in range(parts + 1)], 0.0)
    for i in range(parts):
        low, high = bounds[i] if i else -1, bounds[i + 1]
        chunk = events.where((F.col("event_id") > low) & (F.col("event_id") <= high))
        chunk.coalesce(1).write.mode("append").parquet(path)
    return path


def stream(spark, path):
    reader = spark.readStream.schema(retail.SCHEMAS["events"]).option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def labelled(events):
    outcome = (F.col("event_type") == "purchase").cast("int").alias("final_label")
    return retail.prediction_rows(events, outcome).select(*KEYS)


def stream_table(spark, schema):
    name = f"stream_{uuid.uuid4().hex}"
    tables.ensure_stream_table(spark, name, schema, new_path(spark, "stream"))
    return name


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def test_blocks_that_span_micro_batches(spark, sf_dir):
    path, out = events_in_order(spark, sf_dir, 4), new_path(spark, "blocks")
    jobs.count_blocks(labelled(stream(spark, path)), f"{out}/rows", f"{out}/state", 100)
    batch = block_accuracy(
        labelled(retail.read(spark, sf_dir, "events")), 100, "predicted_at", "uuid", ["model_id"]
    )
    assert rows(jobs.counted_blocks(spark, f"{out}/rows", 100)) == rows(batch)
    assert spark.read.parquet(f"{out}/rows/parts").select("epoch").distinct().count() == 4


def test_blocks_follow_time_over_shuffled_files(spark, sf_dir):
    path, out = new_path(spark, "events"), new_path(spark, "blocks")
    events = retail.read(spark, sf_dir, "events").repartition(5, F.xxhash64("event_id"))
    events.write.parquet(path)
    source = labelled(stream(spark, path))
    # Files that are shuffled over the whole time are late by all of it.
    jobs.count_blocks(source, f"{out}/rows", f"{out}/state", 100, lateness="1000 days")
    batch = block_accuracy(labelled(events), 100, "predicted_at", "uuid", ["model_id"])
    assert jobs.counted_blocks(spark, f"{out}/rows", 100).count() == 0
    assert rows(jobs.counted_blocks(spark, f"{out}/rows", 100, waiting=True)) == rows(batch)


def test_responses_wait_for_their_turn_and_late_ones_are_kept(spark):
    path, out = new_path(spark, "responses"), new_path(spark, "blocks")
    schema = (
        "uuid long, model_id string, predicted_at timestamp_ntz, final_label int, response_label int"
    )

    def arrive(*minutes):
        data = [(m, None, f"2024-01-01 00:{m:02d}:00", 1, m % 2) for m in minutes if m is not None]
        data += [(99, None, None, 1, 1) for m in minutes if m is None]
        df = spark.createDataFrame(data, schema.replace("timestamp_ntz", "string"))
        df = df.withColumn("predicted_at", F.col("predicted_at").cast("timestamp_ntz"))
        df.coalesce(1).write.mode("append").parquet(path)
        source = spark.readStream.schema(schema).parquet(path)
        jobs.count_blocks(source, f"{out}/rows", f"{out}/state", 2, lateness="10 minutes")

    def found(waiting):
        blocks = jobs.counted_blocks(spark, f"{out}/rows", 2, waiting=waiting)
        return [(r.block, r.started_at.minute, r.ended_at.minute) for r in blocks.orderBy("block").collect()]

    arrive(5, 1, 9)
    assert found(False) == [] and found(True) == [(0, 1, 5)]
    arrive(3, 20, None)  # 10 has passed: 1, 3, 5 and 9 have had their turn
    assert found(False) == [(0, 1, 3), (1, 5, 9)]
    arrive(4, 22, 11)  # 4 is late
    assert found(False) == [(0, 1, 3), (1, 5, 9)]
    assert found(True) == [(0, 1, 3), (1, 5, 9), (2, 11, 20)]
    late = spark.read.parquet(f"{out}/rows/late")
    assert sorted(r.uuid for r in late.collect()) == [4, 99]


def test_a_later_run_goes_on_where_the_last_one_stopped(spark, sf_dir):
    path, out = events_in_order(spark, sf_dir, 2), new_path(spark, "blocks")
    for _ in range(2):
        jobs.count_blocks(labelled(stream(spark, path)), f"{out}/rows", f"{out}/state", 50)
    total = spark.read.parquet(f"{out}/rows/parts").agg(F.sum("responses")).first()[0]
    assert total == retail.read(spark, sf_dir, "events").count()


def test_delayed_labels_over_micro_batches(spark, sf_dir):
    path, out = events_in_order(spark, sf_dir, 3), new_path(spark, "labels")
    jobs.delayed_labels(
        retail.prediction_rows(stream(spark, path)),
        retail.truth_rows(stream(spark, path)),
        f"{out}/rows",
        f"{out}/state",
        lateness="10 minutes",
        within="1 hour",
    )
    batch = attach_labels(retail.predictions(spark, sf_dir), retail.truth(spark, sf_dir))
    assert rows(spark.read.parquet(f"{out}/rows")) == rows(batch)


def test_truth_after_the_bound_is_not_matched(spark, sf_dir):
    path, out = events_in_order(spark, sf_dir, 1), new_path(spark, "labels")
    late = retail.truth_rows(stream(spark, path)).withColumn(
        "labelled_at", F.expr("labelled_at + interval 2 hours")
    )
    jobs.delayed_labels(
        retail.prediction_rows(stream(spark, path)),
        late,
        f"{out}/rows",
        f"{out}/state",
        lateness="10 minutes",
        within="1 hour",
    )
    assert spark.read.schema("uuid string").parquet(f"{out}/rows").count() == 0


def test_windows_wait_for_the_watermark_and_drop_late_rows(spark):
    path, out = new_path(spark, "late"), new_path(spark, "windows")
    schema = "predicted_at timestamp_ntz, final_label int, response_label int"

    def arrive(*times):
        data = [(t, 1, i % 2) for i, t in enumerate(times)]
        df = spark.createDataFrame(data, "t string, final_label int, response_label int")
        moment = F.col("t").cast("timestamp_ntz").alias("predicted_at")
        rows = df.select(moment, "final_label", "response_label")
        rows.coalesce(1).write.mode("append").parquet(path)
        source = spark.readStream.schema(schema).parquet(path)
        jobs.windowed_accuracy(source, f"{out}/rows", f"{out}/state", window="1 hour", lateness="10 minutes")

    arrive("2024-01-01 00:10:00", "2024-01-01 00:20:00", "2024-01-01 02:00:00")
    arrive("2024-01-01 00:30:00", "2024-01-01 04:00:00")  # the first of these is too late
    arrive("2024-01-01 06:00:00")
    got = rows(spark.read.parquet(f"{out}/rows").select("started_at", "responses", "accuracy"))
    assert [(a, n, str(t)) for a, n, t in got] == [
        (0.0, 1, "2024-01-01 02:00:00"),
        (0.5, 2, "2024-01-01 00:00:00"),
        (1.0, 1, "2024-01-01 04:00:00"),
    ]


def test_ingest_marks_each_micro_batch(spark, sf_dir):
    path, out = events_in_order(spark, sf_dir, 2), new_path(spark, "ingest")
    source = stream(spark, path).select("event_id", F.lit(1).alias("conversion"))
    table = stream_table(spark, projection.ingest_batch(source, F.lit("")).schema)
    jobs.ingest(source, table, f"{out}/state", "b")
    stored = spark.table(table)
    assert {r[0] for r in stored.select("batch_id").distinct().collect()} == {"b-0", "b-1"}
    assert stored.where("conversion is not null").count() == 0
    assert stored.count() == retail.read(spark, sf_dir, "events").count()


def test_a_replayed_epoch_replaces_its_rows(spark, sf_dir, monkeypatch):
    path, state = events_in_order(spark, sf_dir, 3), new_path(spark, "state")
    source = stream(spark, path).select("event_id", F.lit(1).alias("conversion"))
    table = stream_table(spark, projection.ingest_batch(source, F.lit("")).schema)
    write, epochs = jobs.replace_epoch, []

    def fails_once(df, name, origin, epoch):
        write(df, name, origin, epoch)
        epochs.append(epoch)
        if epochs == [0, 1]:
            raise RuntimeError("lost after the write, before the commit")

    monkeypatch.setattr(jobs, "replace_epoch", fails_once)
    with pytest.raises(Exception, match="lost after the write"):
        jobs.ingest(source, table, state, "b")
    jobs.ingest(source, table, state, "b")
    assert epochs == [0, 1, 1, 2]
    stored = spark.table(table)
    events = retail.read(spark, sf_dir, "events").count()
    assert stored.count() == stored.select("event_id").distinct().count() == events


def test_streams_share_a_table_and_an_epoch_can_become_empty(spark):
    table = stream_table(spark, spark.range(1).schema)
    tables.replace_epoch(spark.range(3), table, "a", 0)
    tables.replace_epoch(spark.range(5), table, "b", 0)
    tables.replace_epoch(spark.range(7), table, "a", 1)
    assert spark.table(table).count() == 15
    tables.replace_epoch(spark.range(0), table, "a", 1)
    assert rows(spark.table(table).groupBy("stream", "epoch").count()) == [(3, 0, "a"), (5, 0, "b")]
    with pytest.raises(ValueError, match="a name"):
        tables.replace_epoch(spark.range(1), table, "a'b", 0)
    with pytest.raises(ValueError, match="no column"):
        tables.replace_epoch(spark.range(1).withColumnRenamed("id", "di"), table, "a", 0)


def test_scores_equal_the_batch_and_the_model_is_asked_per_batch(spark, sf_dir):
    columns = ["interaction_id", *retail.FEATURES, "conversion"]
    rows = projection.as_label(retail.interactions(spark, sf_dir, columns))
    model = training.fit_pipeline(
        training.training_rows(rows, "interaction_id"),
        training.random_forest(numTrees=3),
        "interaction_id",
    )
    source, out = new_path(spark, "orders"), new_path(spark, "scores")
    orders = retail.read(spark, sf_dir, "orders")
    for part in (orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 2 = 1")):
        part.coalesce(1).write.mode("append").parquet(source)
    reader = spark.readStream.schema(retail.SCHEMAS["orders"]).option("maxFilesPerTrigger", 1)
    arriving = retail.interactions(spark, sf_dir, columns, reader.parquet(source))
    asked = []

    def latest():
        asked.append(1)
        return model

    def select(df):
        return df.select("interaction_id", "label", "prediction")

    table = stream_table(spark, select(model.transform(rows)).schema)
    jobs.score(projection.as_label(arriving), table, f"{out}/state", "s", latest, select)
    stored = spark.table(table).drop("stream", "epoch")
    ours = sorted(map(str, stored.collect()))
    assert ours == sorted(map(str, select(model.transform(rows)).collect()))
    assert len(asked) == 2
