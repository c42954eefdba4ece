"""Each query against its SQL in DuckDB, over whole small tables."""

import pytest

from rolodeck.plans import catalogue

from .compare import database, normal

QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def db(small):
    return database(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, small, db, name):
    ours, theirs = QUERIES[name](spark, small).toPandas(), db.sql(ORACLES[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert normal(ours) == normal(theirs)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, small, name):
    assert QUERIES[name](spark, small).count() > 0
