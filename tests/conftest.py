import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from recensio.session import local_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", 4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def one(spark):
    """Value of a column function for one text."""
    from pyspark.sql import functions as F

    def value(function, text):
        df = spark.createDataFrame([(text,)], "x string")
        return df.select(function(F.col("x")).alias("y")).first()["y"]

    return value
