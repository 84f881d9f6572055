"""Every registered query against its SQL at the smallest scale."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as spark_entry
from tools.check_oracle import compare, connect

ROOT = os.environ.get("QUERY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(spark_entry.queries()))
def test_query(spark, con, name):
    if name not in spark_entry.oracle_sql():
        pytest.skip("no SQL; held against plain versions in tests/llm")
    assert compare(spark, con, ROOT, name) is None


def test_oracles_belong_to_queries():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).count() > 0
