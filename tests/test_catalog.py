"""Every registered query against its DuckDB oracle (exact rows) at sf0.001."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from gpsweave.catalog import queries
from gpsweave.oracles.catalog_sql import oracle_sql
from oracle_harness import compare

# the training-data queries have their own tests
NAMES = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["taxi_id", "event_id", "ts_ms", "total_distance_km", "total_time_s",
                          "average_speed_kmph"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck001, name):
    r = compare(spark, duck001, name, E.queries()[name], E.oracle_sql()[name], SF001)
    assert r["cols_ok"], r
    assert r["spark_rows"] == r["duck_rows"], r
    assert r["values_ok"], r
