"""Every query with an SQL equivalent, against DuckDB on the smallest tables."""

import pytest

from checks.compare import differences, duck
from checks.queries import ORACLES, QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def connection():
    return duck(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, connection, name):
    assert differences(spark, connection, SMALL, name) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())
