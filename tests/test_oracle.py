import pytest
from compare import spark_rows, sql_rows

import __spark_entry__ as contract
from ledgerlens.testkit.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert contract.oracle_sql().keys() >= QUERIES.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, name):
    names, rows = spark_rows(contract.queries()[name](spark, SF_DIR))
    expected_names, expected = sql_rows(contract.oracle_sql()[name], SF_DIR)
    assert names == expected_names
    assert rows == expected
    assert rows
