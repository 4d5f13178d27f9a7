"""The driver contract, and a sample of queries against DuckDB."""

import pytest

import __spark_entry__ as contract
from checks.compare import connect, differences
from tests.conftest import SMALL

SAMPLE = ("flagged_fhv", "mart_executive_monthly", "mart_hvfhv_service_quality", "zone_profile_features", "run_state",
          "coverage", "version_history", "slowest_routes")


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    queries, oracles = contract.queries(), contract.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 200


def test_oracles_name_only_given_tables():
    con = connect(SMALL)
    for name, sql in contract.oracle_sql().items():
        con.execute(f"EXPLAIN {sql}")


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_oracle(spark, name):
    problem, _ = differences(spark, connect(SMALL), SMALL, contract.queries()[name], contract.oracle_sql()[name])
    assert not problem
