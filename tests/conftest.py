import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

DATA = "/root/testdata"
SF001 = f"{DATA}/sf0.001"
SF01 = f"{DATA}/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    ckpt = tempfile.mkdtemp(prefix="crashlens-test-ckpt-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("crashlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.checkpoint.dir", ckpt)
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from crashlens.sources.fixture import load_fixture

    return load_fixture(spark, SF001)


@pytest.fixture(scope="session")
def tables01(spark):
    from crashlens.sources.fixture import load_fixture

    return load_fixture(spark, SF01)


@pytest.fixture
def tmp_out(spark):
    from crashlens.session import scratch_path

    return scratch_path(spark, "test-out")
