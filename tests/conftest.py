import os
import sys

import pytest
from pyspark.sql import Column, SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kpiloom.session import RUNTIME_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("kpiloom-tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g")
               .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config(map=RUNTIME_CONF).getOrCreate())
    session.sparkContext.setLogLevel("OFF")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """``rows(df)`` as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=lambda t: [(v is not None, v) for v in t])


@pytest.fixture
def evaluate(spark):
    """Values of a column expression (or a function of the column) over a table ``x``."""
    def run(expression, values, type_="string"):
        if not isinstance(expression, Column):
            expression = expression(F.col("x"))
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {type_}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]
    return run
