"""Registered queries beside their SQL at the smallest scale (``ALL_QUERIES=1`` for all)."""

import os

import pytest

import __spark_entry__ as entry_module
from tools.check import compare, connect

FOLDER = "/root/testdata/sf0.001"
SLOW = ("i15", "blind_audit")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", [n for n in QUERIES if os.environ.get("ALL_QUERIES") or not n.startswith(SLOW)])
def test_query(spark, con, name):
    ok, n, why = compare(spark, con, FOLDER, name, QUERIES[name], SQL.get(name))
    assert ok is not False, why


def test_entry_and_names(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(SQL) <= set(QUERIES)
