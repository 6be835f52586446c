"""The window form of the machine against the ping-by-ping step, on random
vehicles that leave and re-enter the zone, halt, end trips and arrive late."""

import random

from pyspark.sql import functions as F

from gpsweave.operators.lifecycle import lifecycle
from gpsweave.operators.machine import trip_chain
from gpsweave.operators.machine_chunks import trip_chain_chunked
from gpsweave.config import DEFAULT
from gpsweave.operators.speed import speed_chain
from gpsweave.operators.speed_chunks import speed_chain_chunked

SCHEMA = ("taxi_id string, event_id long, arrival_key long, ts_ms long, latitude double, longitude double, "
          "end_flag boolean, produced_ts double")
TRIP = ["kind", "area_violations", "area_event", "warned", "step_s", "halt_event", "halted", "total_distance_km",
        "total_time_s", "trip_reset", "avg_reason", "average_speed_kmph", "status_before", "status", "stored_total",
        "fleet_delta_cents"]
SPEED = ["speed_reason", "speed_kmph", "is_speeding", "speeding_count"]


def random_pings(seed, vehicles=60, pings=90):
    rng, rows = random.Random(seed), []
    for v in range(vehicles):
        t, lat, lon = 1_704_067_200_000, 39.9163, 116.3972
        for _ in range(rng.randint(1, pings)):
            k = rng.random()
            if k < 0.12:      # outside
                lat, lon = 39.9163 + rng.choice([-1, 1]) * 0.2, 116.3972
            elif k < 0.3:     # near the 10 km line
                lat, lon = 39.9163 + rng.uniform(0.085, 0.095), 116.3972
            elif k < 0.6:     # somewhere inside
                lat, lon = 39.9163 + rng.uniform(-0.02, 0.02), 116.3972 + rng.uniform(-0.02, 0.02)
            t += rng.choice([0, 1000, 1500, 60_000, 240_000, 1_000_000])
            late = rng.random() < 0.08
            rows.append((str(v), len(rows), len(rows), t - 3_600_000 * late, lat, lon, rng.random() < 0.08, t / 1000))
    rng.shuffle(rows)
    return rows


def test_window_form_equals_the_step(spark):
    for seed in (1, 2, 3):
        pings = spark.createDataFrame(random_pings(seed), SCHEMA)
        step, trips = lifecycle(pings), trip_chain(pings)
        assert trips.count() == step.count() > 1000
        assert step.select("event_id", *TRIP).exceptAll(trips.select("event_id", *TRIP)).count() == 0
        speeds = speed_chain(pings)
        fwd = step.filter("kind = 'forwarded'").select("event_id", *SPEED)
        assert fwd.exceptAll(speeds.select("event_id", *SPEED)).count() == 0 and fwd.count() == speeds.count()
        said = step.select("event_id", F.explode("events").alias("e")).filter("e.kind <> 'speeding'").select("event_id", "e.kind", "e.message")
        says = trips.select("event_id", F.explode("events").alias("e")).select("event_id", "e.kind", "e.message")
        assert said.exceptAll(says).count() == 0 and said.count() == says.count() > 0
        assert {r.status for r in trips.select("status").distinct().collect()} >= {"active", "removed", "inactive"}


def test_chunked_anchor_equals_the_sequential_one(spark):
    """Chunks of a few pings that start speculatively: every result and count, and no chunk above its size."""
    for seed, rows, head in ((4, 3, 2), (5, 12, 256)):
        pings = spark.createDataFrame(random_pings(seed, vehicles=25, pings=60), SCHEMA)
        want, got = speed_chain(pings), speed_chain_chunked(pings, DEFAULT.with_(scan_chunk_rows=rows), head)
        assert got.columns == want.columns and got.count() == want.count() > 200
        assert want.exceptAll(got).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert speed_chain_chunked(empty, DEFAULT.with_(scan_chunk_rows=3)).count() == 0


def test_chunked_machine_equals_the_windows(spark):
    """Composed chunk states: every column, message and event, with chunks of a few pings."""
    for seed, rows in ((6, 3), (7, 11)):
        pings = spark.createDataFrame(random_pings(seed, vehicles=40, pings=80), SCHEMA)
        want, got = trip_chain(pings), trip_chain_chunked(pings, DEFAULT.with_(scan_chunk_rows=rows))
        assert got.columns == want.columns
        assert sorted(map(str, want.collect())) == sorted(map(str, got.collect()))
        seen = want.select(F.collect_set("status"), F.collect_set("halt_event"), F.collect_set("trip_reset")).first()
        assert {len(seen[0]), len(seen[1]), len(seen[2])} <= {2, 3, 4} and "removal" in seen[2]
    empty = spark.createDataFrame([], SCHEMA)
    assert trip_chain_chunked(empty, DEFAULT.with_(scan_chunk_rows=3)).count() == 0


def test_positions_that_are_not_finite_are_dropped(spark):
    from gpsweave.operators.parse import parse_pings
    lines = ["1,2024-01-01 00:00:00,116.40,39.91,0,1.0", "1,2024-01-01 00:01:00,116.40,NaN,0,1.0",
             "1,2024-01-01 00:02:00,Infinity,39.91,0,1.0", "1,2024-01-01 00:03:00,116.41,39.92,0,1.0"]
    msgs = spark.createDataFrame([(i, i, x) for i, x in enumerate(lines)], "event_id long, arrival_key long, message string")
    pings = parse_pings(msgs, keep=["event_id", "arrival_key"])
    assert sorted(r.event_id for r in pings.collect()) == [0, 3]
    raw = spark.createDataFrame([("1", 0, 0, 0, 39.91, 116.40, False, 0.0), ("1", 1, 1, 60_000, float("nan"), 116.4, False, 0.0),
                                 ("1", 2, 2, 120_000, 39.92, float("inf"), False, 0.0), ("1", 3, 3, 180_000, 39.92, 116.41, False, 0.0)], SCHEMA)
    for out in (lifecycle(raw), trip_chain(raw)):
        assert sorted(r.event_id for r in out.collect()) == [0, 3]
    assert trip_chain(raw).filter("has_step").count() == 1


def test_fleet_sums_have_the_same_bits_for_any_partitioning(spark):
    from gpsweave.operators.views import fleet_dashboard, fleet_distance, vehicle_state
    pings = spark.createDataFrame(random_pings(9), SCHEMA)
    seen = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (1, 8, 64):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            trips, speeds = trip_chain(pings), speed_chain(pings)
            seen.add((fleet_distance(trips).first()[0].hex(),
                      *(x.hex() if isinstance(x, float) else x for x in fleet_dashboard(vehicle_state(trips, speeds)).first())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(seen) == 1


def test_chunk_passes_join_one_carry(spark):
    rows = [("1", i, i, 39.9 + 0.01 * (i % 5), 116.39, i % 7 == 0) for i in range(30)]
    df = spark.createDataFrame(rows, "taxi_id string, event_id long, arrival_key long, latitude double, longitude double, end_flag boolean")
    df = df.selectExpr("*", "1704067200000 + 40000 * event_id AS ts_ms", "1.0D AS produced_ts")
    plan = trip_chain_chunked(df, DEFAULT.with_(scan_chunk_rows=3))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1


def test_the_meeting_points_need_no_rows(spark, monkeypatch):
    from gpsweave.operators import speed_chunks
    plans, written = {}, speed_chunks._written

    def spy(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return written(df, name)
    monkeypatch.setattr(speed_chunks, "_written", spy)
    rows = [("1", i, i, 39.9 + 0.01 * (i % 5), 116.39, i % 7 == 0) for i in range(30)]
    df = spark.createDataFrame(rows, "taxi_id string, event_id long, arrival_key long, latitude double, longitude double, end_flag boolean")
    df = df.selectExpr("*", "1704067200000 + 40000 * event_id AS ts_ms", "1.0D AS produced_ts")
    assert speed_chain_chunked(df, DEFAULT.with_(scan_chunk_rows=3), 2).count() > 0
    assert plans["speed-info"].count("Join ") == 2
