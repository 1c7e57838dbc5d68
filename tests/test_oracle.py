"""Every registered query against its SQL twin; ``ORACLE_DIR`` picks the tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from compare import differences, duck

FOLDER = os.environ.get("ORACLE_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no sample tables")


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_a_twin():
    assert entry.QUERIES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    assert differences(df, con, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
