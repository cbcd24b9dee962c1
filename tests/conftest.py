"""One small local session for all tests."""

from __future__ import annotations

import os
from pathlib import Path

import pytest
from pyspark.sql import DataFrame, SparkSession

from trustlake import get_spark

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory: pytest.TempPathFactory) -> SparkSession:
    shared = tmp_path_factory.mktemp("shared")
    events = shared / "events"
    events.mkdir()
    session = get_spark(
        "trustlake-tests",
        master="local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(shared / "warehouse"),
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(shared / "scratch"),
            # executed plans are read from here
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": events.as_uri(),
            "spark.eventLog.rolling.enabled": "false",
            "spark.eventLog.compress": "false",
            "spark.eventLog.buffer.kb": "1k",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def small() -> str:
    return SMALL


@pytest.fixture
def folder(tmp_path: Path) -> str:
    return str(tmp_path)


def text_frame(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    """All-text rows, as a raw file gives them."""
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def plan_of(df: DataFrame) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()
