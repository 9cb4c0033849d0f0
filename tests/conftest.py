import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    session = builder.getOrCreate()
    if not session.conf.get("spark.checkpoint.dir", ""):
        session.stop()
        session = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="docmonitor-")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a column expression over one string column ``x``."""

    def run(fn, inputs):
        from pyspark.sql import functions as F

        rows = [(i, x) for i, x in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, x string").coalesce(1)
        return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]

    return run
