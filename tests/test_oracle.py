"""Every registered query against its SQL, on the smallest tables."""

import pytest

from chatprep.plans import ORACLES, QUERIES
from tests.oracle import DATA, compare, connect

SF = "sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, str(DATA / SF))
    problems = [p for p in compare(con, df, ORACLES[name]) if p != "no rows"]
    assert not problems


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert contract.queries().keys() >= QUERIES.keys()
    assert contract.oracle_sql().keys() >= ORACLES.keys()
