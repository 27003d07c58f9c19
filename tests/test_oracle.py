"""Every named query equals its DuckDB twin over the whole tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from airledger.plans import oracle, queries as named
from tests.conftest import DATA

SF_DIR = os.environ.get("TEST_SF_DIR", f"{DATA}/sf0.01")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        table = name.removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{name}'")
    return connection


def test_every_query_has_a_twin():
    assert {*named.BATCH, *named.STREAMS} == set(oracle.oracle_sql())
    assert set(oracle.oracle_sql()) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_twin(spark, database, name):
    frame = contract.queries()[name](spark, SF_DIR)
    twin = database.sql(contract.oracle_sql()[name])
    columns = sorted(frame.columns)
    assert columns == sorted(twin.columns)
    at = [twin.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in at) for r in twin.fetchall()), key=repr)
    got = sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
    assert len(got) == len(want) > 0
    assert got == want


def test_expected_counts(spark):
    if not SF_DIR.endswith("sf0.01"):
        pytest.skip("counts are those of sf0.01")
    queries = contract.queries()
    counts = {
        "readings": 9500, "alerts": 6407, "table_state_from_changes": 8501, "current_status": 5,
        "avg_1m": 7424, "avg_1m_stream": 7411, "hourly_aggregates": 300, "hourly_stream": 275,
        "daily_patterns": 120, "daily_summary": 150, "alert_summary_hourly": 2994,
        "sensor_stats_24h": 7424,
    }
    assert {name: queries[name](spark, SF_DIR).count() for name in counts} == counts


def test_entry_runs(spark):
    frame = contract.entry(spark)
    assert frame.count() == 288
    assert frame.columns == ["sensor_id", "location", "window_end", "avg_co2", "min_co2", "max_co2"]
