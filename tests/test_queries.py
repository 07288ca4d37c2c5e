"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check
from catalog import queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check.database(SF)


def test_every_query_has_sql():
    assert set(registered.ALL) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(registered.ALL))
def test_query_equals_sql(spark, con, name):
    got = entry.queries()[name](spark, SF).toPandas()
    want = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert check.rows(got) == check.rows(want)


def test_entry(spark):
    assert entry.entry(spark).columns == ["url", "keyword", "points"]
