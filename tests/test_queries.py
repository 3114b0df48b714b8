"""Every registered query against its SQL."""

import compare
import pytest

import __spark_entry__ as contract
from refsync.plans.queries import QUERIES, SQL

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert compare.differences(result, database, contract.oracle_sql()[name]) == ""


def test_entry(spark):
    assert contract.entry(spark).limit(1).count() == 1
