import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from noticelake.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", shuffle_partitions=4, app="tests")
    yield session
    session.stop()


@pytest.fixture()
def workdir():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")


@pytest.fixture(scope="session")
def evaluate(spark):
    """Evaluate a Column builder over a list of values, in one job."""
    from pyspark.sql import functions as F

    def run(build, values, kind="string"):
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[0] for r in rows.orderBy("i").select(build(F.col("v")).alias("r")).collect()]

    return run
