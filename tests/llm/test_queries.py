"""The registered queries against DuckDB, where SQL can say them."""

import oracle
import pytest

from shelfsight.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    connection = oracle.connect(sf_dir)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, con, sf_dir, name):
    assert oracle.difference(QUERIES[name](spark, sf_dir), con, ORACLES[name]) is None


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
