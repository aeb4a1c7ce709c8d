"""Every registered query against its SQL twin on the smallest tables."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from ledgerlark.plans import REGISTRY

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


def test_names_match():
    assert set(oracle_sql()) <= set(queries())
    assert len(queries()) >= 80


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, name).startswith("same")


def test_entry(spark):
    assert entry(spark).count() > 0
