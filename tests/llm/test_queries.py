"""Corpus queries against their DuckDB twins."""

from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracles  # noqa: E402

from offerlift.llm.queries import ORACLES, QUERIES  # noqa: E402


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_duckdb(spark, sf_dir, name):
    con = check_oracles.duck(sf_dir)
    status, _ = check_oracles.compare(spark, con, sf_dir, QUERIES[name], ORACLES[name])
    assert status.startswith("ok"), status
