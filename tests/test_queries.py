"""Every registered query against its SQL in DuckDB, on the smallest test tables."""

import pytest

from harness import catalog, oracles
from harness.compare import differences, open_duckdb
from lamina.operators import skew

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return open_duckdb(SF)


@pytest.mark.parametrize("name", list(catalog.queries()))
def test_query(spark, con, name):
    problems, rows, _ = differences(spark, con, SF, name)
    assert not problems
    assert rows > 0 or name == "dq_failed"


@pytest.mark.parametrize("name", [
    "fact_claims", "fact_encounters", "q1_revenue_cycle", "q2_readmission", "anti_join_rehash",
    "latest_version", "fk_orphans",
])
def test_query_planned_for_large_tables(spark, con, no_broadcast, monkeypatch, name):
    """Nothing is broadcast, and frequent keys (NULL, the few payers) are spread."""
    monkeypatch.setattr(skew, "HOT_MIN_ROWS", 10)
    problems, _, _ = differences(spark, con, SF, name)
    assert not problems


def test_every_query_has_a_counterpart():
    assert set(oracles.oracle_sql()) == set(catalog.queries())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
