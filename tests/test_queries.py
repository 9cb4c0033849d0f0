"""Every registered query against its SQL, on the smallest data set."""

import os

import pytest

from checks import compare
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

SINGLE_PAGE = {"next_page_links"}  # so little data that every list has one page


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("test data not available")
    return compare.database(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem = compare.compare(spark, con, SF_DIR, name, QUERIES[name], ORACLE[name])
    assert problem == ("equal but empty" if name in SINGLE_PAGE else None)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    # other queries may be there that SQL can't express
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql()) <= set(entry.queries())
