import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from scorelab.session import local_session

    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def rated(spark):
    """The published confusion matrix as a table of (y, guess)."""
    from pyspark.sql import functions as F

    cells = spark.createDataFrame([(0, 0, 4048), (0, 1, 202), (1, 0, 626), (1, 1, 187)], "y int, guess int, n int")
    return cells.select("y", "guess", F.explode(F.sequence(F.lit(1), "n"))).drop("col")
