import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from feedloom.session import local_session

    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def values(spark):
    """Evaluate a column function on a list of strings."""
    from pyspark.sql import functions as F

    def run(inputs, fn):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
        return [r[0] for r in df.orderBy("i").select(fn(F.col("v")).alias("r")).collect()]

    return run
