from __future__ import annotations

import os
import sys
from datetime import date, datetime  # noqa: F401

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adloom.session import apply_settings  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    session.stop()


@pytest.fixture(scope="session")
def views(spark):
    from adloom.catalog import Views

    return Views(spark, SF_DIR)


@pytest.fixture
def rows(spark):
    """Sorted rows of a frame as tuples."""

    def of(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return of
