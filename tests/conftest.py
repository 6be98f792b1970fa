from __future__ import annotations

import os
import tempfile

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="tidemark-test-")
    session = (
        SparkSession.builder.master(os.environ.get("TEST_MASTER", "local[8]"))
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .config("spark.local.dir", f"{scratch}/local")
        .config(
            "spark.driver.extraJavaOptions",
            f"-Dderby.system.home={scratch}/derby -Dderby.stream.error.file={scratch}/derby.log",
        )
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
