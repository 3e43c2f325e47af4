"""Every registered query against its SQL statement, and the entry file."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from strata.queries import QUERIES
from tests.compare import connect, differences


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if q.sql])
def test_matches_sql(spark, data, con, name):
    q = QUERIES[name]
    assert differences(q.run(spark, data), con, q.sql) is None


@pytest.mark.parametrize("name", [n for n, q in QUERIES.items() if not q.sql])
def test_runs(spark, data, name):
    assert QUERIES[name].run(spark, data).count() > 0


def test_entry_functions_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(q.covers for q in QUERIES.values())


def test_no_query_name_or_folder_is_reserved():
    assert not [n for n in QUERIES if n == "pipeline" or n.startswith("op")]
