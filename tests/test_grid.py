"""Traffic grid: truncating cell index, status thresholds, exact means."""

import pytest
from pyspark.sql import functions as F

from gpsweave.config import DEFAULT
from gpsweave.functions.geo import grid_id
from gpsweave.operators.grid import grid_window, traffic_status, with_grid_id


def test_grid_index_truncates_toward_zero(spark):
    c = DEFAULT
    below = c.grid_min_lat - 0.5 * c.lat_delta          # index -0.5 -> 0, not -1
    inside = c.grid_min_lat + 1.5 * c.lat_delta
    df = spark.createDataFrame([(below, c.grid_min_lon + 0.1 * c.lon_delta),
                                (inside, c.grid_min_lon + 2.5 * c.lon_delta)], "lat double, lon double")
    got = [r.g for r in df.select(grid_id(F.col("lat"), F.col("lon")).alias("g")).collect()]
    assert got == ["0_0", "1_2"]


@pytest.mark.parametrize("avg,n,want", [
    (4.99, 3, "CONGESTED"), (5.0, 3, "MODERATE"), (14.99, 3, "MODERATE"), (15.0, 3, "FREE_FLOW"),
    (9.0, 2, "MODERATE"), (10.0, 2, "FREE_FLOW"), (4.0, 2, "MODERATE"), (1.0, 1, "FREE_FLOW"),
])
def test_traffic_status_rule(spark, avg, n, want):
    df = spark.createDataFrame([(avg, n)], "a double, n long")
    assert df.select(traffic_status(F.col("a"), F.col("n")).alias("s")).first().s == want


def test_latest_speed_per_vehicle_per_window(spark):
    c = DEFAULT.with_(grid_window="1 hour")
    rows = [("a", 1, "2024-01-01 00:00:01", 39.9163, 116.3972, 10.0),
            ("a", 2, "2024-01-01 00:10:00", 39.9163, 116.3972, 20.0),   # latest of a
            ("b", 3, "2024-01-01 00:20:00", 39.9163, 116.3972, 5.0),
            ("b", 4, "2024-01-01 01:20:00", 39.9163, 116.3972, 7.0)]    # next window
    df = spark.createDataFrame(rows, "taxi_id string, event_id long, t string, latitude double, "
                                     "longitude double, speed_kmph double").withColumn("ts", F.to_timestamp("t"))
    out = {(r.window.start.hour, r.vehicles): r.avg_speed_kmph for r in grid_window(df, c).collect()}
    assert out == {(0, 2): 12.5, (1, 1): 7.0}


def test_windows_opened_by_the_first_record(spark):
    """Against a walk through each cell's records, with chunks of two rows: ties, gaps, records at the very end of a window."""
    import random
    from gpsweave.config import DEFAULT
    from gpsweave.operators.grid_first import grid_window_first_record
    rng = random.Random(4)
    rows = []
    for i in range(160):
        cell, t = rng.randrange(4), rng.choice([0, 3, 7, 10, 10, 13, 20, 21, 35, 60, 61, 70, 90]) + rng.choice([0, 100])
        rows.append((str(rng.randrange(4)), i, 39.9 + cell * 0.01, 116.4, float(rng.randrange(1, 60)), t * 1_000_000))
    rows.append(("9", 999, 39.9, 116.4, 5.0, None))
    df = spark.createDataFrame(rows, "taxi_id string, event_id long, latitude double, longitude double, speed_kmph double, us long")
    df = df.withColumn("ts", F.timestamp_micros("us")).drop("us")
    got = {(r.grid_id, r.window_start_us): (r.avg_speed_kmph, r.vehicles)
           for r in grid_window_first_record(df, DEFAULT.with_(scan_chunk_rows=2)).collect()}
    cells, want = {}, {}
    ids = {r.event_id: r.grid_id for r in with_grid_id(df).select("event_id", "grid_id").collect()}
    for tid, e, _, _, speed, us in rows:
        if us is not None:
            cells.setdefault(ids[e], []).append((us, e, tid, speed))
    for cell, records in cells.items():
        start, seen = None, {}
        for us, e, tid, speed in sorted(records):
            if start is None or us >= start + 10_000_000:
                start, seen = us, {}
            seen[tid] = speed
            want[cell, start] = (sum(seen.values()) / len(seen), len(seen))
    assert {k: (round(a, 6), n) for k, (a, n) in got.items()} == {k: (round(a, 6), n) for k, (a, n) in want.items()}
    assert grid_window_first_record(df.filter("false")).count() == 0
