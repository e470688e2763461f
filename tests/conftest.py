import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from safetymart.schemas import FDA_RAW, FSIS_RAW  # noqa: E402
from safetymart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = build_session(
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": str(home / "warehouse"),
            "spark.checkpoint.dir": str(home / "shared"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        }
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def plan_of(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def rows():
    """Sorted rows as tuples, for comparing whole results."""

    def sort(df):
        return sorted(map(tuple, df.collect()), key=repr)

    return sort


@pytest.fixture
def fda(spark):
    """FDA records from dicts; fields left out are null."""

    def make(*records):
        data = [[r.get(f) for f in FDA_RAW.fieldNames()] for r in records]
        return spark.createDataFrame(data, FDA_RAW)

    return make


@pytest.fixture
def fsis(spark):
    def make(*records):
        data = [[r.get(f) for f in FSIS_RAW.fieldNames()] for r in records]
        return spark.createDataFrame(data, FSIS_RAW)

    return make
