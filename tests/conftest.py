"""One local session for all tests."""

import os
import shutil
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    folder = tempfile.mkdtemp(prefix="rosta-tests-")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.checkpoint.dir", folder)
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
    shutil.rmtree(folder, ignore_errors=True)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
