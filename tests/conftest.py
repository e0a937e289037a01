import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from zonepulse.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "local[8]", "tests",
        **{
            "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Small frames from rows and a DDL schema."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def value(spark):
    """One column expression over one row."""

    def evaluate(col, row=None, schema=None):
        df = spark.createDataFrame([row], schema) if schema else spark.range(1)
        return df.select(col.alias("v")).first()["v"]

    return evaluate
