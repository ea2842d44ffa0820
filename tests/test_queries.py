import pytest

import __spark_entry__ as contract
from compare import connect, differences

SF = "/root/testdata/sf0.001"
ORACLES = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert differences(spark, duck, contract.queries()[name], ORACLES[name], SF) is None


def test_every_sql_has_a_query():
    assert set(ORACLES) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
