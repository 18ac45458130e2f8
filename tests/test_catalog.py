import pytest

from marketlane.plans.catalog_runs import CHECKS, QUERIES
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def con(small):
    return connect(small)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_its_sql(spark, con, small, name):
    assert compare(spark, con, small, name, QUERIES[name], CHECKS.get(name)) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(CHECKS)
