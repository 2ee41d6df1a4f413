import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pulseboard.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
AS_OF = datetime(2024, 1, 31, 12)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def one(spark, value, build, kind="string"):
    """The result of one expression over one value."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(build(F.col("x")).alias("y")).first()["y"]


def column(spark, values, build, kind="string"):
    """The results of one expression over many values, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    return [r["y"] for r in df.select("i", build(F.col("x")).alias("y")).orderBy("i").collect()]
