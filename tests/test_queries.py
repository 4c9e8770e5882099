"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest
from check import DATA, compare, database

from __spark_entry__ import entry, oracle_sql, queries
from eventmart.plans.oracles import ORACLES
from eventmart.plans.queries import QUERIES

SF_DIR = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def db():
    return database(SF_DIR)


def test_every_query_has_sql():
    assert sorted(QUERIES) == sorted(ORACLES)
    assert QUERIES.keys() <= queries().keys() and ORACLES.keys() <= oracle_sql().keys()


def test_entry(spark):
    rows = entry(spark)
    assert rows.columns == ["mode", "time_ns", "equity"] and rows.count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    problem = compare(db, queries()[name](spark, SF_DIR), oracle_sql()[name])
    assert problem is None
