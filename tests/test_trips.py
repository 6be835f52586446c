"""Geofence operators: exact against DuckDB windows, for any chunk size."""

import pytest
from pyspark.sql import functions as F

from conftest import SF01
from gpsweave.config import DEFAULT
from gpsweave.operators.trips import fence_steps
from gpsweave.oracles.fixtures_sql import TRIPS, with_
from gpsweave.oracles.trips_sql import steps_ctes
from gpsweave.sources.fixtures import trips
from oracle_harness import rows_of

COLS = ["taxi_id", "event_id", "accepted", "discarded", "forwarded", "area_violations", "area_event"]


@pytest.mark.parametrize("rows", [1, 2, 5, 1 << 20])
def test_fence_matches_plain_windows_for_any_chunking(spark, duck01, rows):
    s = fence_steps(trips(spark, SF01), DEFAULT.with_(scan_chunk_rows=rows)).select(
        *[F.col(c).cast("long") if c == "area_violations" else F.col(c) for c in COLS])
    got = rows_of(s.columns, [tuple(r) for r in s.collect()])
    sql = (f"{with_(TRIPS, steps_ctes('trips', DEFAULT))}\nSELECT "
           + ", ".join(f"CAST({c} AS BIGINT) AS {c}" if c == "area_violations" else c for c in COLS) + " FROM steps")
    rel = duck01.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    assert len(got) == len(want) == 10000
    assert got == want
