"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as contract
from checks.compare import mismatch, oracle_connection
from checks.oracles import ORACLES
from checks.registry import QUERIES
from conftest import SF_DIR


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, connection, name):
    assert mismatch(spark, connection, SF_DIR, name) is None


def test_contract(spark):
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.columns == ["rang_vaccinal", "date_debut_semaine", "nb"] and not result.isEmpty()
