import os

import pytest
from compare import assert_same, oracle_frame

import __spark_entry__ as contract
from ticketloom.registry.queries import QUERIES as OWN_QUERIES

SF_DIR = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()
QUERIES = {name: contract.queries()[name] for name in OWN_QUERIES}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_every_query_has_sql():
    assert QUERIES.keys() <= ORACLES.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, name):
    assert_same(QUERIES[name](spark, SF_DIR).toPandas(), oracle_frame(ORACLES[name], SF_DIR))


def test_entry(spark):
    assert contract.entry(spark).count() == 30
