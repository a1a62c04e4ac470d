"""Every registered query against its SQL, run by DuckDB on the same tables."""

import pytest
from compare import duck, same

import __spark_entry__ as contract
from registry.oracles import ORACLES
from registry.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, connection, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert same(result, ORACLES[name], connection) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_a_row_per_day(spark):
    result = contract.entry(spark)
    assert result.columns == ["date", "n_rows", "e_zpass", "vtoll"]
    assert result.count() == 30
