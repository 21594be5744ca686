"""Every registered query against its DuckDB oracle at sf0.01 (the driver's gate)."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tessera.plans.registry import QUERIES
from tests.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"
os.environ.setdefault("ORACLE_EXACT", "1")   # every query matches DuckDB bit for bit; keep it so


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_library_query_has_oracle_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(spark, con, name, SF, queries()[name], oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.columns == ["COMM", "crimes_per_capita", "income_per_capita"]
    assert df.count() >= 0
