"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check


@pytest.fixture(scope="module")
def connection(sf_dir):
    return check.connect(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, connection, sf_dir, name):
    ok, note, _, _ = check.compare(spark, connection, name, sf_dir)
    assert ok, note


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
