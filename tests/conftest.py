from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from siliscope.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("siliscope-tests", cores=8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def part(spark, data):
    return spark.read.parquet(f"{data}/part.parquet")


class Rows(list):
    """Rows that compare without regard to order."""

    def __eq__(self, other):
        return sorted(self, key=repr) == sorted(other, key=repr)


@pytest.fixture(scope="session")
def rows():
    return lambda df: Rows(tuple(r) for r in df.collect())
