import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    s = (SparkSession.builder.master("local[4]").appName("plenaria-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .getOrCreate())
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="plenaria-test-ckpt-"))
    yield s


@pytest.fixture
def one_col(spark):
    """Evaluate a Column function over a list of input values."""
    def run(fn, values, ddl="string"):
        df = spark.createDataFrame([(v,) for v in values], f"x {ddl}")
        return [r[0] for r in df.select(fn("x")).collect()]
    return run
