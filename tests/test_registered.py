"""Every registered query against its SQL, on the smallest tables."""

import pytest

import registered
from compare import database, difference

FOLDER = "/root/testdata/sf0.001"
registered.load_all()


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(registered.QUERIES))
def test_agrees_with_sql(spark, connection, name):
    assert difference(spark, connection, FOLDER, name) is None


def test_every_query_has_sql():
    assert set(registered.QUERIES) == set(registered.SQL)
