"""Every named query against its SQL on the given tables."""

import os

import pytest
from compare import connect, differences

from telepulse.plans.catalog import QUERIES
from telepulse.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="tables not there")


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck, ORACLES[name]) == []


def test_entry(spark):
    import __spark_entry__ as contract

    if os.path.isdir(contract.SMOKE_DIR):
        assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())
