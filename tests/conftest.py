import datetime as dt
import os

import pytest
from pyspark.sql import SparkSession

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def d(text):
    """Date from ISO text, or None."""
    return None if text is None else dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULL first."""
    found = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(found, key=lambda row: [(v is not None, v if v is not None else 0) for v in row])
