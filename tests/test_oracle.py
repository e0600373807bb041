"""Each registered query against its SQL on the generated tables."""

import pytest
from compare import differences, oracle_connection
from conftest import TESTDATA

import __spark_entry__ as entry_point
from testbed import registry

SF_DIR = str(TESTDATA / "sf0.01")
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    con = oracle_connection(SF_DIR)
    yield con
    con.close()


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= entry_point.queries().keys()
    assert ORACLES.keys() <= entry_point.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_same_rows_as_sql(spark, oracle, name):
    assert differences(QUERIES[name](spark, SF_DIR), oracle, ORACLES[name]) == []


def test_entry(spark):
    panel = entry_point.entry(spark)
    assert panel.columns == [
        "Year",
        "Country",
        "TotalEmissions",
        "PerCapitaEmissions",
        "ShareOfGlobalEmissions",
        "AverageTemperature",
    ]
    assert panel.count() > 0
