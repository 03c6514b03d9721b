import pytest

from __spark_entry__ import entry, oracle_sql, queries
from contract.oracle import ORACLE
from contract.queries import REGISTRY
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert REGISTRY.keys() == ORACLE.keys()
    assert REGISTRY.items() <= queries().items()
    assert ORACLE.items() <= oracle_sql().items()


def test_entry(spark):
    assert entry(spark).count() == 20


@pytest.mark.parametrize("name", REGISTRY)
def test_query_equals_its_sql(spark, con, name):
    assert differences(REGISTRY[name](spark, SF_DIR), con, ORACLE[name]) == []
