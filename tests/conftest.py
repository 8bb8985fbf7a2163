from __future__ import annotations

import json
import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(__file__)]

from pyspark.sql import functions as F  # noqa: E402

from aeroflow import schemas  # noqa: E402
from aeroflow.session import local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
SMALL_DIR = os.environ.get("TEST_SMALL_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = str(tmp_path_factory.mktemp("shared"))
    settings = {
        "spark.checkpoint.dir": shared,
        # Plan texts are checked, so they must not be cut short.
        "spark.sql.maxMetadataStringLength": "2000",
    }
    session = local_session(8, "aeroflow-tests", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data at {SF_DIR}")
    return SF_DIR


@pytest.fixture(scope="session")
def small_dir():
    if not os.path.isdir(SMALL_DIR):
        pytest.skip(f"no test data at {SMALL_DIR}")
    return SMALL_DIR


@pytest.fixture
def messages(spark):
    """Records of a topic from values (text, documents, or None) or (key, value) pairs."""

    def make(values, topic="t", first_offset=0, wave=0):
        rows = []
        for i, value in enumerate(values):
            key = None
            if isinstance(value, tuple):
                key, value = value
            if isinstance(value, (dict, list)):
                value = json.dumps(value)
            rows.append((key, value, topic, 0, first_offset + i, wave))
        frame = spark.createDataFrame(
            rows, "key string, value string, topic string, partition int, offset bigint, wave int"
        )
        return frame.select(
            F.col("key").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            "topic",
            "partition",
            "offset",
            F.timestamp_seconds(F.lit(1_735_689_600) + F.col("wave")).alias("timestamp"),
        ).select(*schemas.MESSAGE_FIELDS)

    return make
