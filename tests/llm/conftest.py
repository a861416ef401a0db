import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import ODD, SCHEMA  # noqa: E402
from shopmill.llm.common import show_package  # noqa: E402


@pytest.fixture(autouse=True, scope="session")
def package(spark):
    show_package(spark)


@pytest.fixture
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
