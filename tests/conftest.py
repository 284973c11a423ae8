from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__  # noqa: E402,F401  (sends the package's functions to the workers)
from plaint.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "8")
    builder = builder.config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
    builder = builder.config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session = configure(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Evaluate columns over one-row frames: ``rows(column, [value, ...])``."""

    def run(column, values, kind="string"):
        frame = spark.createDataFrame([(v,) for v in values], f"x {kind}")
        return [row[0] for row in frame.select(column).collect()]

    return run
