import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from quillspark.session import local_session, ship_package  # noqa: E402

# column expressions at module level need a running session while tests are collected
SESSION = local_session(8, memory="8g")
SESSION.sparkContext.setLogLevel("OFF")
ship_package(SESSION)


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def texts(spark):
    """DataFrame (i, text) of the given strings."""

    def make(*values):
        return spark.createDataFrame(list(enumerate(values)), "i int, text string")

    return make


@pytest.fixture
def evaluate(texts):
    """Values of a column expression over the given texts, in order."""

    def run(expression, *values):
        rows = texts(*values).select("i", expression.alias("v")).orderBy("i").collect()
        return [r.v for r in rows]

    return run
