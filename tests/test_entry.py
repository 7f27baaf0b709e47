"""Registered queries against their SQL at the smallest scale."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test data not present")


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    without = {"train_candidates", "candidate_metrics", "batch_predict"} | set(entry.LLM_QUERIES) - set(entry.LLM_ORACLES)
    assert set(entry.queries()) - set(entry.oracle_sql()) == without


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, connection, name):
    assert compare(spark, connection, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name]) == []


def test_entry_has_rows(spark):
    df = entry.entry(spark)
    assert "sales_lag_28" in df.columns and not df.isEmpty()
