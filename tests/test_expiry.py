"""Idle vehicles expire: sessions in batch, event-time timers in streams."""

import tempfile

from pyspark.sql import functions as F

from gpsweave.config import DEFAULT
from gpsweave.operators.sessions import trip_chain_with_expiry, vehicle_sessions, with_sessions
from gpsweave.operators.parse import parse_pings
from gpsweave.sources import fixtures as FX
from gpsweave.sources.files import vehicle_report
from gpsweave.streaming.expiry import expiring_vehicle_stream, session_sinks
from gpsweave.streaming.live import MESSAGE_SCHEMA, replay_vehicle_stream
from conftest import SF001

MINUTE = 60_000
START_S = 1704067200


def _messages(spark, pings):
    """pings: (vehicle, minute) in order of arrival."""
    rows = [(i, i, f"{v},2024-01-01 {m // 60:02d}:{m % 60:02d}:00,{116.39 + 0.001 * i:.6f},39.916000,0,{START_S + 60 * m}")
            for i, (v, m) in enumerate(pings)]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


def _replayed(spark, messages, steps):
    root = tempfile.mkdtemp(prefix="gw-expiry-")
    replay_vehicle_stream(messages, root, steps, stream=lambda m: expiring_vehicle_stream(m, 30 * MINUTE, "10 minutes"), sinks=session_sinks)
    return spark.read.parquet(f"{root}/out/sessions")


def test_timers_flush_idle_vehicles_whatever_the_batches(spark):
    clock = [("c", 10 * i) for i in range(21)]
    pings = sorted(clock + [("a", 0), ("a", 1), ("a", 100), ("b", 0), ("d", 0), ("d", 30), ("d", 61)], key=lambda x: (x[1], x[0]))
    messages = _messages(spark, pings)
    at_once, in_parts = _replayed(spark, messages, 1), _replayed(spark, messages, 3)
    rows = at_once.drop("batch_id")
    assert rows.count() == in_parts.count() == len(pings) + 5
    assert rows.exceptAll(in_parts.drop("batch_id").select(*rows.columns)).count() == 0
    ends = {(r.taxi_id, (r.session_start_ms // 1000 - START_S) // 60, (r.ts_ms // 1000 - START_S) // 60)
            for r in rows.filter("kind = 'expired'").collect()}
    # d is silent for exactly the limit once (goes on) and for a minute more the next time; c is still there
    assert ends == {("a", 0, 31), ("a", 100, 130), ("b", 0, 30), ("d", 0, 60), ("d", 61, 91)}
    assert rows.filter("kind = 'expired' AND (event_id IS NOT NULL OR status IS NOT NULL)").count() == 0
    # b has one ping: its end can only come from a timer, in a batch of its own
    assert [r.batch_id for r in at_once.filter("taxi_id = 'b'").orderBy("ts_ms").collect()] == [0, 1]
    batch = trip_chain_with_expiry(parse_pings(messages, keep=["event_id", "arrival_key"]), 30 * MINUTE)
    same = ["taxi_id", "session_start_ms", "event_id", "kind", "status", "total_distance_km", "total_time_s", "avg_reason", "stored_total"]
    live = rows.filter("kind <> 'expired'").select(*same)
    assert live.count() == batch.count() and live.exceptAll(batch.select(*same)).count() == 0


def test_sessions_dont_depend_on_chunks(spark):
    pings = FX.trips(spark, SF001)
    want = with_sessions(pings, 30 * MINUTE)
    got = with_sessions(pings, 30 * MINUTE, DEFAULT.with_(scan_chunk_rows=3, scan_fan_out=2))
    assert want.count() == got.count() == pings.count()
    assert want.exceptAll(got.select(*want.columns)).count() == 0


def test_sessions_of_awkward_rows(spark):
    cols = "taxi_id string, ts_ms long, latitude double, longitude double, end_flag boolean, produced_ts double, arrival_key long, event_id long"
    assert vehicle_sessions(spark.createDataFrame([], cols), MINUTE).count() == 0
    row = lambda v, m, i: (v, m * MINUTE, 39.9, 116.4, False, 0.0, i, i)
    # a late ping belongs to the session that is open when it arrives; ties don't part sessions; no id is a vehicle too
    rows = [row("1", 0, 0), row("1", 5, 1), row("1", 1, 2), row("1", 5, 3), row(None, 0, 4), row(None, 9, 5)]
    got = {(r.taxi_id, r.session_start_ms // MINUTE, r.newest_ms // MINUTE, r.pings, r.expires_ms // MINUTE)
           for r in vehicle_sessions(spark.createDataFrame(rows, cols), 2 * MINUTE).collect()}
    assert got == {("1", 0, 0, 1, 2), ("1", 5, 5, 3, 7), (None, 0, 0, 1, 2), (None, 9, 9, 1, 11)}


def test_vehicle_report_has_all_three_states(spark):
    parts = spark.createDataFrame([("1", 3, "read"), ("1", 0, "empty"), ("2", 0, "unreadable"), ("2", 2, "read"), ("3", 0, "unreadable"),
                                   ("3", 0, "empty"), ("4", 0, "empty"), (None, 1, "read")], "vehicle string, lines long, state string")
    listed = spark.createDataFrame([("1",), ("5",), ("5",), (None,)], "vehicle string")
    got = {r.vehicle: (r.state, r.lines) for r in vehicle_report(listed, parts).collect()}
    assert got == {"1": ("read", 3), "2": ("read", 2), "3": ("unreadable", 0), "4": ("empty", 0), "5": ("empty", 0)}
    assert {r.state for r in vehicle_report(listed, parts.limit(0)).collect()} == {"empty"}
