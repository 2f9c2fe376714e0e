import pytest

import __spark_entry__ as contract
from query_set.oracles import ORACLES
from query_set.queries import QUERIES
from tests.check_oracles import differences, oracle_connection

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_query_has_sql():
    assert {n for n in contract.queries() if n in QUERIES} == set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", list(contract.oracle_sql()))
def test_query_matches_sql(spark, connection, name):
    wrong, rows = differences(spark, connection, SF_DIR, name)
    assert not wrong
    assert rows > 0


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
