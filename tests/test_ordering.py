from __future__ import annotations

from decimal import Decimal

import datetime as dt

import pytest
from pyspark.sql import functions as F

from offerlift.operators.monitoring import accuracy_drift, block_accuracy
from offerlift.operators.ordering import latest_n, with_row_index, with_running_totals


def shuffled(spark, n):
    return spark.range(n).select(
        "id", F.expr("cast(pmod(xxhash64(id), 50) as int)").alias("v")
    ).repartition(5)


def test_row_index_is_the_global_order(spark):
    rows = with_row_index(shuffled(spark, 1000), ["v", F.desc("id")]).collect()
    want = sorted(rows, key=lambda r: (r["v"], -r["id"]))
    assert [r["row_index"] for r in want] == list(range(1, 1001))


def test_row_index_restarts_in_each_group_even_a_hot_one(spark):
    df = shuffled(spark, 900).withColumn(
        "g", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("v")))
    )
    groups = {}
    for r in with_row_index(df, ["id"], ["g"]).collect():
        groups.setdefault(r["g"], []).append((r["id"], r["row_index"]))
    assert len(groups["hot"]) == 300
    for rows in groups.values():
        assert [i for _, i in sorted(rows)] == list(range(1, len(rows) + 1))


def test_row_index_keeps_null_groups(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id int, g string")
    got = {r["id"]: r["row_index"] for r in with_row_index(df, ["id"], ["g"]).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_running_totals(spark):
    df = shuffled(spark, 500)
    rows = with_running_totals(df, [F.desc("id")], {"run": "v"}).collect()
    total = 0
    for r in sorted(rows, key=lambda r: -r["id"]):
        total += r["v"]
        assert r["run"] == total
    assert {r["run_total"] for r in rows} == {total}


def test_running_totals_of_other_types_nulls_and_no_rows(spark):
    rows = [(i, i if i % 3 else None, i / 4, Decimal(i) / 8) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, n int, x double, d decimal(12, 3)").repartition(7)
    totals = {"run_n": "n", "run_x": "x", "run_d": "d"}
    got = sorted(with_running_totals(df, ["id"], totals).collect())
    n = x = d = 0
    for r, (i, a, b, c) in zip(got, rows, strict=True):
        n, x, d = n + (a or 0), x + b, d + c
        assert (r.id, r.n, r.run_n, r.run_x, r.run_d) == (i, a, n, x, d)
    assert (got[0].run_n_total, got[0].run_x_total, got[0].run_d_total) == (n, x, d)
    assert with_running_totals(df.where("id < 0"), ["id"], totals).count() == 0


def test_running_totals_shuffle_one_row_per_partition(spark):
    """Behind the written sort, rows meet neither a window nor an exchange of their own."""
    df = with_running_totals(shuffled(spark, 1000), ["id"], {"run": "v"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    left = plan.split("BroadcastHashJoin")[1].split("BroadcastExchange")[0]
    assert "FileScan parquet" in left and "Window" not in left and "Exchange" not in left


def test_no_step_sorts_all_rows_in_one_task(spark):
    """Windows over everything see one row per partition only."""
    df = with_row_index(shuffled(spark, 1000), ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "FileScan parquet" in plan and "Sort [id" not in plan  # sorted rows were written


def times(spark, rows):
    return spark.createDataFrame(rows, "id int, t timestamp_ntz, day date")


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


ROWS = [(i, at(1 + i // 4, i % 3), at(1 + i // 4).date()) for i in range(40)]


@pytest.mark.parametrize("day_col", [None, "day"])
@pytest.mark.parametrize("n", [1, 5, 39, 40, 100])
def test_latest_n(spark, n, day_col):
    got = [r["id"] for r in latest_n(times(spark, ROWS), n, "t", "id", day_col).collect()]
    want = sorted(ROWS, key=lambda r: (-r[1].timestamp(), r[0]))[:n]
    assert got == [r[0] for r in want]


@pytest.mark.parametrize("day_col", [None, "day"])
def test_latest_n_with_missing_times(spark, day_col):
    rows = [*ROWS[:3], (90, None, None), (91, None, None)]
    got = [r["id"] for r in latest_n(times(spark, rows), 4, "t", "id", day_col).collect()]
    assert got[3:] == [90]
    assert latest_n(times(spark, rows).where("t is null"), 2, "t", "id", day_col).count() == 2
    assert latest_n(times(spark, []), 2, "t", "id", day_col).count() == 0


def responses(spark, n):
    start = at(1)
    rows = [
        (str(i).zfill(4), start + dt.timedelta(seconds=i // 7), i % 2, (i // 3) % 2)
        for i in range(n)
    ]
    schema = "uuid string, predicted_at timestamp_ntz, final_label int, response_label int"
    return spark.createDataFrame(rows, schema).repartition(4), rows


@pytest.mark.parametrize("n", [0, 99, 100, 101, 250])
def test_only_full_blocks_count(spark, n):
    df, rows = responses(spark, n)
    got = {r["block"]: r for r in block_accuracy(df, 100, "predicted_at", "uuid").collect()}
    assert sorted(got) == list(range(n // 100))
    for b, r in got.items():
        block = rows[100 * b : 100 * b + 100]
        assert r["accuracy"] == pytest.approx(sum(x[2] == x[3] for x in block) / 100)
        assert (r["started_at"], r["ended_at"]) == (block[0][1], block[-1][1])


def test_drift_is_the_difference_to_the_block_before(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.75), (2, 0.25)], "block bigint, accuracy double")
    got = {r["block"]: (r["previous_accuracy"], r["drift"]) for r in accuracy_drift(df).collect()}
    assert got == {0: (None, None), 1: (0.5, 0.25), 2: (0.75, -0.5)}


def test_drift_stays_inside_its_group(spark):
    rows = [("a", 0, 0.5), ("a", 1, 1.0), ("b", 1, 0.25), ("b", 2, 0.5)]
    df = spark.createDataFrame(rows, "model_id string, block bigint, accuracy double")
    drifts = accuracy_drift(df, ["model_id"]).collect()
    got = {(r["model_id"], r["block"]): r["drift"] for r in drifts}
    assert got == {("a", 0): None, ("a", 1): 0.5, ("b", 1): None, ("b", 2): 0.25}
