"""Every query against its SQL on the given tables."""

import pytest

from tests.conftest import SF_DIR
from verification.compare import connect, difference
from verification.oracle import oracle_sql
from verification.queries import queries


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()


@pytest.mark.parametrize("name", list(queries()))
def test_same_result(spark, con, name):
    assert difference(queries()[name](spark, SF_DIR), con, oracle_sql()[name]) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert queries().keys() <= contract.queries().keys()
    assert queries().keys() <= contract.oracle_sql().keys() <= contract.queries().keys()
