"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import compare, connect  # noqa: E402
from siliscope.registry import all_queries  # noqa: E402


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, data, duck, name):
    query = all_queries()[name]
    ours = query.run(spark, data).toArrow()
    if query.sql is not None:
        assert compare(ours, duck.execute(query.sql).to_arrow_table()) is None


def test_entry_points(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 20
