import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

_TESTS = os.path.dirname(os.path.abspath(__file__))
_ROOT = os.path.dirname(_TESTS)
sys.path.insert(0, _ROOT)
# Python workers import the annotators that tests define.
os.environ["PYTHONPATH"] = os.pathsep.join([_ROOT, _TESTS, os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    if session.sparkContext.getConf().get("spark.checkpoint.dir") is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
    yield session
    session.stop()
