"""Every registered job against its DuckDB oracle on the smallest driver tables."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from lakeweave.plans import registry
from lakeweave.plans.verify import compare, duckdb_connection

ORACLES = registry.oracles()
QUERIES = {n: q for n, q in E.queries().items() if n in registry.queries()}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle_or_is_listed():
    without = sorted(set(QUERIES) - set(ORACLES))
    assert without == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = con.execute(ORACLES[name]).df()
    diff = compare(got, want)
    assert diff is None, f"{name}: {diff}"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"segment", "nb_clients", "ca", "pct_clients"} <= set(df.columns)
