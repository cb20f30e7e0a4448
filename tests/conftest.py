import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tagloom.settings import apply_settings
    from tagloom.sinks.scratch import drop_scratch

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tagloom-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield apply_settings(session)
    drop_scratch(session)


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture
def rows():
    """The rows of a frame as sorted tuples, nulls first."""

    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, v) for v in r])

    return collect


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def database(spark):
    from tagloom.sinks.scratch import shared_database

    return shared_database(spark)
