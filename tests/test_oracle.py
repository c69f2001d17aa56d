"""Every registered query against its DuckDB SQL on the smallest test tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from martlake.plans.oracle import oracle_sql
from martlake.plans.registry import QUERIES
from tests.conftest import SF001
from tests.oracle_check import compare, duck

KEYS = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_query_has_sql():
    assert set(oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_sql(spark, con, key):
    info = compare(spark, con, key, entry.queries()[key], entry.oracle_sql()[key], SF001)
    assert info["ok"], info


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "stat_date"
    assert df.count() > 0
