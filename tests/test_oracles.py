"""Every registered query with SQL gives the rows DuckDB gives; the others give rows."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, connect

JOBS, SQLS = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="session")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_query(spark, con, sf_dir, name):
    ok, note, _ = compare(spark, con, sf_dir, JOBS[name], SQLS.get(name))
    assert ok is not False, note


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(SQLS) <= set(JOBS)
