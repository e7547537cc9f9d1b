import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="delaylake-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    from delaylake.session import tune

    yield tune(session)
    session.stop()


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
