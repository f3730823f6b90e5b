"""Every catalogue query against DuckDB on the same files."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracles  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracles.duck(sf_dir)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_duckdb(spark, con, sf_dir, name):
    status, _ = check_oracles.compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert status.startswith("ok"), status


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["threshold", "blast_profit", "targeted_profit"]
    assert result.count() == 10
