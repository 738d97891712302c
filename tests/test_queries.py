"""Every registered query against its SQL in DuckDB."""

import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"h29_fitted_model"}


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_only_named_queries_lack_sql():
    own = {name for name in queries() if not re.match(r"op\d+_|pipeline$", name)}
    assert own - set(oracle_sql()) == WITHOUT_SQL


def test_entry_runs(spark):
    assert entry(spark).count() == 4


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, queries()[name], oracle_sql().get(name), SF)
    assert ok, note
