"""Every registered query: equal to its SQL, or at least runnable."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from compare import database, differences

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf_dir, db, name):
    assert differences(spark, sf_dir, name, QUERIES[name], ORACLES[name], db) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry(spark):
    df = entry_point.entry(spark)
    assert {"check_id", "scenario_id", "pass_rate", "status"} <= set(df.columns)
    assert df.count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
