import pytest

import __spark_entry__ as contract
from tests.oracle import connect, difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", contract.queries())
def test_query_equals_its_sql(spark, tables, name):
    result = contract.queries()[name](spark, SF_DIR)
    if name in contract.oracle_sql():
        assert difference(result, tables, contract.oracle_sql()[name]) is None
    else:
        assert result.count() > 0
