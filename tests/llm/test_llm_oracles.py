"""The operators' queries against their DuckDB oracles on the smallest driver tables."""

import pytest

from conftest import SF_SMALL
from lakeweave.llm import registry
from lakeweave.plans.verify import compare, duckdb_connection


def test_every_number_has_its_query():
    assert sorted(n.split("_")[0] for n in registry.QUERIES) == sorted([*(f"op{k}" for k in range(1, 14)), "pipeline"])


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_matches_oracle(spark, name):
    got = registry.QUERIES[name](spark, SF_SMALL).toPandas()
    want = duckdb_connection(SF_SMALL).execute(registry.ORACLES[name]).df()
    assert compare(got, want) is None
