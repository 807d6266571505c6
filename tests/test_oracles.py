"""Every registered query against its check SQL on the smallest tables."""

from __future__ import annotations

import pytest

from tidemark.suite import ORACLES, QUERIES
from tools.check_queries import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    problems, n = compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name])
    assert not problems
    assert n > 0


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 86
