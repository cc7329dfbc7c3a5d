import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g", spark__checkpoint__dir=str(root / "scratch"),
        spark__sql__warehouse__dir=str(root / "warehouse"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """The rows of a frame as sorted plain tuples."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect


@pytest.fixture
def plan():
    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()
    return text
