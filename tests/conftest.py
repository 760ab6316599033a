from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[4]")
        .appName("tessera-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tessera-wh-"))
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    from tessera.session import checkpoint_dir

    checkpoint_dir(session)  # only registers a folder when none is configured
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="tessera-test-")
