"""Every registered query against its SQL on the smallest driver tables."""

import pytest

from metforge.workload import ORACLES, QUERIES
from oracle import compare, connect


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    problems = [p for p in compare(spark, con, name, QUERIES[name], ORACLES[name], sf) if not p.endswith("no rows")]
    assert not problems


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark, sf):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(QUERIES) <= set(e.queries())  # the training-text queries may be added
