from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TESTDATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tideline-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_small() -> str:
    return f"{TESTDATA}/sf0.001"


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return f"{TESTDATA}/sf0.01"


@pytest.fixture
def make_chunks(spark):
    """Chunk rows from (dimensions, chunk_id, points) with points as (timestamp, value)."""
    from tideline.model import CHUNKS, DIMENSIONS

    def make(*rows):
        data = []
        for dimensions, chunk_id, points in rows:
            times = [t for t, _ in points]
            data.append((
                *[dimensions.get(d) for d in DIMENSIONS], chunk_id,
                min(times, default=0), max(times, default=0), len(points),
                [(t, float(v)) for t, v in points], None,
            ))
        return spark.createDataFrame(data, CHUNKS)

    return make


def scan_text(frame) -> str:
    """The formatted physical plan as text."""
    mode = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return frame._jdf.queryExecution().explainString(mode)
