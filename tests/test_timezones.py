"""Wall clocks do not depend on the session's time zone."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import functions as F

from offerlift.functions import timestamps

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracles  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

QUERIES = ["epoch_ms", "metric_times", "ts_parse", "ts_suffix", "registry_latest", "stream_accuracy"]


@pytest.fixture
def new_york(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("name", [*QUERIES, "stream_delayed_labels"])
def test_queries_in_new_york(new_york, sf_dir, name):
    con = check_oracles.duck(sf_dir)
    query, sql = entry.queries()[name], entry.oracle_sql()[name]
    status, _ = check_oracles.compare(new_york, con, sf_dir, query, sql)
    assert status.startswith("ok"), status


def test_the_hour_that_summer_time_skips(new_york):
    texts = ["2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 03:30:00.000001"]
    df = new_york.createDataFrame([(t,) for t in texts], "t string")
    ts = timestamps.parse_iso(F.col("t"))
    made = df.select(
        ts.cast("string").alias("ts"),
        timestamps.epoch_micros(ts).alias("micros"),
        timestamps.from_epoch_micros(timestamps.epoch_micros(ts)).cast("string").alias("back"),
        timestamps.parse_suffix(timestamps.time_suffix(ts)).cast("string").alias("suffix"),
    ).collect()
    assert [r["ts"] for r in made] == texts == [r["back"] for r in made]
    assert [r["suffix"] for r in made] == [t[:19] for t in texts]
    assert made[1]["micros"] - made[0]["micros"] == 3_600_000_000
    assert made[2]["micros"] - made[1]["micros"] == 3_600_000_001
    early = new_york.sql("select timestamp_ntz'1969-12-31 23:59:59.999999' as ts")
    assert early.select(timestamps.epoch_micros(F.col("ts"))).first()[0] == -1
    assert early.select(timestamps.epoch_ms(F.col("ts"))).first()[0] == -1


def test_malformed_texts_give_null(spark):
    df = spark.createDataFrame([("x",), ("2024-13-01 00:00:00",), ("99999999999999",), (None,)], "t string")
    made = df.select(timestamps.parse_iso(F.col("t")), timestamps.parse_suffix(F.col("t"))).collect()
    assert all(tuple(r) == (None, None) for r in made)
