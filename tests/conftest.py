import os
import sys

import pytest

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session(partitions=4)


@pytest.fixture
def folder(spark):
    """A fresh folder for each test."""
    from tablewright.session import scratch

    return scratch(spark, "test")
