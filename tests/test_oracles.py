"""Every registered query against its DuckDB twin, on the whole tables."""

import pytest

import oracle
from __spark_entry__ import entry
from shelfsight.plans import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = oracle.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, sf_dir, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_gives_the_top_products(spark):
    assert entry(spark).count() == 10
