from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from offerlift.functions.paths import normalize_location
from offerlift.operators import projection
from offerlift.sources import files, registry, retail, tables
from offerlift.sources.workspace import new_path

NOW = dt.datetime(2024, 3, 1, 12, 30, 15)


@pytest.fixture
def table(spark):
    name = f"t_{uuid.uuid4().hex}"
    yield name, new_path(spark, "table")
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_append_is_by_name_and_fills_missing_columns(spark, table):
    name, location = table
    tables.ensure_table(spark, name, tables.INTERACTIONS, location=location)
    df = spark.createDataFrame([(0.5, "Ann", 7)], "SCORE double, name string, recency int")
    tables.append(df, name)
    row = spark.table(name).first()
    assert (row["name"], row["recency"], row["score"], row["conversion"]) == ("Ann", 7, 0.5, None)


def test_append_refuses_columns_that_the_table_lacks(spark, table):
    name, location = table
    tables.ensure_table(spark, name, tables.INTERACTIONS, location=location)
    with pytest.raises(ValueError, match="recencyy"):
        tables.append(spark.createDataFrame([(1,)], "recencyy int"), name)
    assert spark.table(name).count() == 0


def test_run_10_is_newer_than_run_9_at_the_same_time(spark):
    runs = [("m", "n", "o", NOW, "x", f"run-{i}") for i in (9, 10, 2)]
    entries = spark.createDataFrame(runs, registry.REGISTRY)
    assert registry.latest(entries).first()["run_id"] == "run-10"


def test_ensure_table_keeps_or_replaces(spark, table):
    name, location = table
    schema = registry.REGISTRY
    tables.ensure_table(spark, name, schema, location=location)
    tables.append(registry.registry_entry(spark, "spark_model", "A_b", NOW, "x", "r"), name)
    tables.ensure_table(spark, name, schema)
    assert spark.table(name).count() == 1
    tables.ensure_table(spark, name, schema, replace=True, location=new_path(spark, "table"))
    assert spark.table(name).count() == 0


def test_a_partitioned_table_is_read_by_newest_day_only(spark, sf_dir, table):
    from pyspark.sql import types as T

    from offerlift.operators.ordering import latest_n

    name, location = table
    schema = T.StructType(
        [
            T.StructField("interaction_id", T.LongType()),
            T.StructField("history", T.IntegerType()),
            T.StructField("batch_tms", T.TimestampNTZType()),
            T.StructField("batch_month", T.StringType()),
        ]
    )
    tables.ensure_table(spark, name, schema, partition_by=["batch_month"], location=location)
    rows = retail.interactions(spark, sf_dir, ["interaction_id", "history", "batch_tms"])
    tables.append(rows.withColumn("batch_month", F.date_format("batch_tms", "yyyy-MM")), name)
    got = latest_n(spark.table(name), 50, "batch_tms", "interaction_id", "batch_month")
    want = latest_n(rows, 50, "batch_tms", "interaction_id")
    assert [r[0] for r in got.collect()] == [r[0] for r in want.collect()]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "batch_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_snapshot_is_written_once(spark, table):
    name, location = table
    tables.write_if_absent(spark.range(3), name, location)
    tables.write_if_absent(spark.range(9), name, location)
    assert spark.table(name).count() == 3


def test_registry_ignores_a_run_it_holds(spark, table):
    name, location = table
    registry.ensure_registry(spark, name, location)
    first = registry.registry_entry(spark, "spark_model", "A_b", NOW, "store/1", "run-1")
    registry.register(first, name)
    registry.register(first.unionByName(first), name)
    later = NOW + dt.timedelta(days=40)
    second = registry.registry_entry(spark, "spark_model", "A_c", later, "store/2", "run-2")
    registry.register(second, name)
    assert spark.table(name).count() == 2
    assert registry.latest_location(spark.table(name), "spark_model") == "store/2"
    with pytest.raises(LookupError):
        registry.latest_location(spark.table(name), "sklearn_model")


def test_two_writers_of_a_run_leave_one_entry(spark, table, monkeypatch):
    name, location = table
    registry.ensure_registry(spark, name, location)
    mine, theirs = (
        registry.registry_entry(spark, "spark_model", "A_b", NOW, where, "run-1")
        for where in ("store/mine", "store/theirs")
    )
    write = registry.append

    def other_writer_first(entries, target):
        monkeypatch.setattr(registry, "append", write)
        checked = spark.createDataFrame(entries.collect(), entries.schema)
        registry.register(theirs, name)  # after the check for the run, before the write
        write(checked, target)

    monkeypatch.setattr(registry, "append", other_writer_first)
    registry.register(mine, name)
    assert spark.table(name).count() == 2
    seen = registry.registered(spark, name).collect()
    assert len(seen) == 1 and seen[0].asDict().keys() == set(registry.REGISTRY.names)
    first = spark.table(name).orderBy("registered_micros", "entry_id").first()
    assert seen[0]["location"] == first["location"]
    registry.register(mine, name)
    assert spark.table(name).count() == 2


def test_lineage(spark, table):
    name, location = table
    tables.ensure_table(spark, name, registry.LINEAGE, location=location)
    registry.record_lineage(spark, name, "m", ["a", "b"], {"k": "v"})
    rows = registry.lineage_edges(spark.table(name)).collect()
    assert {(r["model_name"], r["table_name"], r["metadata"]["k"]) for r in rows} == {
        ("m", "a", "v"),
        ("m", "b", "v"),
    }


def test_artifacts_are_listed_once_and_the_newest_is_found(spark):
    root = new_path(spark, "store")
    for name in ("pipeline_01022024000000", "bestModel_28032021005601", "pipeline_31012024235959"):
        spark.range(2).repartition(2).write.parquet(f"{root}/{name}/data")
    spark.range(1).write.mode("append").parquet(f"{root}/_temporary")
    listed = files.list_artifacts(spark, root)
    assert listed.count() == 3  # folders, not the files in them
    assert "FileScan" not in listed._jdf.queryExecution().executedPlan().toString()
    other = files.list_artifacts(spark, f"file://{root.removeprefix('file:')}/")
    assert other.exceptAll(listed).count() == 0 and other.count() == 3
    newest = files.latest_artifact(listed, "pipeline").collect()
    assert [r["artifact"] for r in newest] == ["pipeline_01022024000000"]


def test_csv_text_typed_and_inferred(spark):
    path = new_path(spark, "csv")
    spark.createDataFrame([(1, "a;b", None)], "x int, y string, z double").coalesce(1).write.option(
        "header", True
    ).option("sep", ";").csv(path)
    text = files.read_csv(spark, path, ";")
    assert set(dict(text.dtypes).values()) == {"string"}
    assert dict(files.read_csv(spark, path, ";", infer=True).dtypes)["x"] == "int"
    out = new_path(spark, "csv")
    files.restamp_csv(spark, path, out, lambda df: projection.stamp_batch(df, F.lit("b1")))
    assert "batch_id" in files.read_csv(spark, out).columns


def test_locations_with_and_without_a_fraction(spark):
    df = spark.createDataFrame(
        [("s/2024-01-02 03:04:05.678901",), ("s/2024-01-02 03:04:05",), ("s/final",), ("final",)],
        "p string",
    )
    got = [r[0] for r in df.select(normalize_location(F.col("p"))).collect()]
    assert got == ["s/02012024030405", "s/02012024030405", "s/final", "final"]


def test_cast_int_of_bad_input(spark):
    df = spark.createDataFrame(
        [("12.9", 2.7), ("x", float("nan")), (None, 1e12)], "a string, b double"
    )
    got = projection.cast_int(df, ["a", "b"]).collect()
    assert [(r["a"], r["b"]) for r in got] == [(12, 2), (None, None), (None, None)]


def test_requests_with_missing_and_malformed_bodies(spark):
    df = spark.createDataFrame(
        [("1", '{"RECENCY": 11, "SCORE": 0.766}'), ("2", "no json")],
        "request_id string, body string",
    )
    parsed = projection.parse_requests(df, ["recency", "score"]).collect()
    rows = {r["request_id"]: r for r in parsed}
    assert (rows["1"]["recency"], rows["1"]["score"]) == (11.0, 0.766)
    assert rows["2"]["recency"] is None
    assert (rows["1"]["error"], rows["2"]["error"]) == (None, "no JSON object")


def test_requests_in_any_case_and_with_gaps(spark):
    bodies = ['{"recency": 1, "SCORE": 2}', '{"Recency": 1, "score": "2"}', '{"RECENCY": 1}']
    bodies += ['{"recency": "x", "score": 1}', "[1]", "", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "request_id int, body string")
    got = {r["request_id"]: r for r in projection.parse_requests(df, ["recency", "score"]).collect()}
    assert [(got[i]["recency"], got[i]["score"]) for i in (0, 1)] == [(1.0, 2.0)] * 2
    assert [got[i]["error"] for i in range(4)] == [None, None, "no number for score", "no number for recency"]
    assert all(got[i]["error"] == "no JSON object" and got[i]["score"] is None for i in (4, 6))
    assert len(got) == len(bodies)


def test_roles(spark, sf_dir):
    df = retail.interactions(spark, sf_dir, [*retail.FEATURES, "conversion"])
    categorical, numeric = projection.column_roles(df, "CONVERSION")
    assert categorical == ["zip_code", "channel", "offer"]
    assert numeric == ["recency", "history", "used_discount", "used_bogo", "is_referral"]
    assert "score" in projection.column_roles(df, "conversion", include_float=True)[1]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from offerlift.sources import workspace

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(RuntimeError):
        workspace.shared_folder(Session())
