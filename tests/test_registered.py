"""Every registered query against its SQL on the smallest tables."""

import pytest

from checks import compare, oracle, registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return compare.connect(FOLDER)


def test_every_query_has_sql():
    assert set(registered.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_agrees_with_sql(spark, tables, name):
    assert compare.differences(spark, tables, FOLDER, name) is None
