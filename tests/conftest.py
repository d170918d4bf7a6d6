import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    from tableferry.session import recommended

    os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")
    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]").appName("tableferry-tests")
        .config(map=recommended(8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file:{base}/shared")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def path(spark):
    """A fresh path per call."""
    from tableferry.session import fresh_path

    return lambda name="t": fresh_path(spark, name)
