import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import AWKWARD, documents  # noqa: E402


@pytest.fixture
def awkward(spark):
    return documents(spark, AWKWARD)


@pytest.fixture
def nothing(spark):
    return documents(spark, [])


@pytest.fixture
def docs(spark):
    return lambda rows: documents(spark, rows)
