"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry
from entryqueries import all_oracles, all_queries
from tests.oracle import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_contract(spark):
    assert set(all_oracles()) == set(all_queries())
    assert set(all_queries()) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    df = entry.entry(spark)
    assert df.columns == ["COUNTYCODE", "County", "AD", "WARD", "ED", "ENROLLMENT", "Count"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, con, name):
    equal, message = compare(entry.queries()[name](spark, SF), con, all_oracles()[name])
    assert equal, message
