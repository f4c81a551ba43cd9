import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import pytest  # noqa: E402

from tidegate.llm.common import ship  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def _package_on_executors(spark):
    ship(spark)
