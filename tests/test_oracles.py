import os

import pytest

from annexport.plans.oracles import ORACLES
from annexport.plans.queries import QUERIES
from tests.compare import connect, oracle_result, spark_result

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    columns, rows = spark_result(spark, name, SF_DIR)
    expected_columns, expected_rows = oracle_result(con, name)
    assert columns == expected_columns
    assert len(rows) == len(expected_rows) > 0
    assert rows == expected_rows
