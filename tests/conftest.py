"""One local session for all tests."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from postloom.session import build_session, scratch_path  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "postloom-tests",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    """A path of this test's own."""
    return scratch_path(spark, "test")
