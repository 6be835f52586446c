"""State machine quirks on hand-written tables (expected values read off the
reference's operator code), checked on both forms of the machine: ping by ping
(streams) and as window expressions (batch)."""

from edge import north, pings
from gpsweave.operators.lifecycle import lifecycle
from gpsweave.operators.machine import trip_chain
from gpsweave.operators.speed import speed_chain
from gpsweave.operators.trips import late_filter

BOTH = ["kind", "area_violations", "area_event", "halt_event", "halted", "total_distance_km", "total_time_s", "trip_reset",
        "avg_reason", "average_speed_kmph", "status_before", "status", "stored_total", "fleet_delta_cents"]


def run(spark, rows, taxi="7"):
    """Rows of the ping-by-ping form, after the window form gave the same."""
    out = [r.asDict() for r in lifecycle(pings(spark, rows, taxi)).orderBy("arrival_key").collect()]
    windows = [r.asDict() for r in trip_chain(pings(spark, rows, taxi)).orderBy("arrival_key").collect()]
    assert [[r[c] for c in BOTH] for r in out] == [[r[c] for c in BOTH] for r in windows]
    return out


def test_late_pings_use_max_accepted_not_previous(spark):
    p = north(1)
    out = run(spark, [(10, p, 0), (20, p, 0), (15, p, 0), (20, p, 0), (18, p, 0)])
    assert [r["kind"] for r in out] == ["forwarded", "forwarded", "late", "forwarded", "late"]
    w = late_filter(pings(spark, [(10, p, 0), (20, p, 0), (15, p, 0), (20, p, 0), (18, p, 0)]))
    assert [r.accepted for r in w.orderBy("arrival_key").collect()] == [True, True, False, True, False]


def test_geofence_warn_discard_reset(spark):
    out = run(spark, [(0, north(8), 0), (60, north(12), 0), (120, north(16), 0), (180, north(12), 0),
                      (240, north(9), 0)])
    assert [r["kind"] for r in out] == ["forwarded", "forwarded", "discarded", "forwarded", "forwarded"]
    assert [r["area_event"] for r in out] == [None, "warn", None, None, "reset"]
    assert out[2]["status"] == "removed" and out[2]["area_violations"] == 1
    msgs = [e["message"] for r in out for e in r["events"]]
    assert "[Removal Alert] Taxi Id:7 removed after exceeding 15km zone. Area violations: 1." in msgs
    assert "[Warning: Area Violation] Taxi Id:7 exceeded 10km zone." in msgs


def test_tiny_steps_round_away(spark):
    rows = [(i * 10, north(1 + i * 0.003), 0) for i in range(100)]
    out = run(spark, rows)
    assert all(r["total_distance_km"] == 0.0 for r in out)


def test_halt_time_is_cumulative(spark):
    a, b = north(1), north(2)
    out = run(spark, [(0, a, 0), (100, a, 0), (200, b, 0), (300, b, 0)])
    assert [r["halt_event"] for r in out] == [None, None, None, "halt"]
    assert out[3]["status"] == "halted"


def test_speed_anchor_stays_on_skipped_ping(spark):
    a, b = north(1), north(2)
    out = run(spark, [(0, a, 0), (10, a, 0), (70, b, 0)])
    assert [r["speed_reason"] for r in out] == ["first", "speed_skipped", "ok"]
    assert out[2]["speed_kmph"] == 51.43 and out[2]["is_speeding"]
    assert any(e["message"] == "[Speeding Alert] Taxi Id:7 is speeding. Violation count: 1."
               for e in out[2]["events"])


def test_unrealistic_speed_keeps_anchor_and_limits(spark):
    a, b, c = north(1), north(2), north(1.5)
    out = run(spark, [(0, a, 0), (10, b, 0), (36, c, 0)])
    assert out[1]["speed_reason"] == "speed_unrealistic"
    assert out[2]["speed_reason"] == "ok" and out[2]["speed_kmph"] == 50.0
    assert out[2]["is_speeding"] is False


def test_end_flag_on_skipped_ping_keeps_anchor(spark):
    a, b = north(1), north(2)
    out = run(spark, [(0, a, 0), (1, a, 1), (100, b, 0)])
    assert out[1]["speed_reason"] == "speed_skipped"
    assert out[2]["speed_reason"] == "ok"


def test_start_outside_stays_removed(spark):
    out = run(spark, [(0, north(16), 0), (60, north(5), 0), (120, north(6), 0), (180, north(7), 0)])
    assert [r["status"] for r in out] == ["removed"] * 4
    assert [r["trip_reset"] for r in out] == [None, "removal", "removal", "removal"]


def test_reentry_counts_whole_total_again(spark):
    out = run(spark, [(0, north(1), 0), (60, north(2), 0), (120, north(16), 0), (180, north(3), 0),
                      (240, north(4), 0)])
    assert out[1]["status"] == "active"
    assert out[2]["status"] == "removed" and out[2]["stored_total"] == 0.0
    # first ping back: step from the pre-excursion place, total re-added to the fleet
    assert out[3]["total_distance_km"] == 2.0 and out[3]["fleet_delta_cents"] == 200
    assert out[3]["status"] == "active" and out[3]["trip_reset"] == "removal"


def test_end_flag_without_distance_is_not_inactive(spark):
    p = north(1)
    out = run(spark, [(0, p, 0), (60, p, 1)])
    assert out[1]["avg_reason"] == "average_skipped"
    assert out[1]["status"] is None


def test_inactive_logged_only_without_previous_status(spark):
    out = run(spark, [(0, north(1), 0), (180, north(2), 1)])
    assert out[1]["status"] == "inactive"
    assert [e["message"] for e in out[1]["events"]] == ["[Status Update] 7is now INACTIVE."]


def test_zero_average_updates_position_but_keeps_stored_average(spark):
    from gpsweave.operators.views import vehicle_state
    rows = [(0, north(1), 0), (180, north(2), 1),                 # trip 1: 20 km/h, ends
            (200, north(3), 0), (20200, north(3.011), 0)]         # trip 2: 0.01 km in 20000 s -> 0.00 km/h
    lc = lifecycle(pings(spark, rows))
    out = [r.asDict() for r in lc.orderBy("arrival_key").collect()]
    assert out[1]["average_speed_kmph"] == 20.0
    assert out[3]["avg_reason"] == "ok" and out[3]["average_speed_kmph"] == 0.0
    st = vehicle_state(trip_chain(pings(spark, rows)), speed_chain(pings(spark, rows))).first()
    assert st.average_speed_kmph == 20.0                          # not overwritten by 0.0
    assert st.last_update_ms == out[3]["ts_ms"] and st.latitude == out[3]["latitude"]


def test_order_ratio_compares_with_previous_ping_not_newest(spark):
    """ts 10, 30, 20, 25: T3 drops 20 and 25 (below the newest accepted, 30);
    Q11 counts 25 as in order (it follows 20)."""
    from gpsweave.operators.prep import order_ratio
    p = north(1)
    df = pings(spark, [(10, p, 0), (30, p, 0), (20, p, 0), (25, p, 0)])
    r = order_ratio(df).first()
    assert (r.in_order, r.out_of_order) == (3, 1)
    assert [x["kind"] for x in run(spark, [(10, p, 0), (30, p, 0), (20, p, 0), (25, p, 0)])] == \
        ["forwarded", "forwarded", "late", "late"]


def test_two_excursions_count_and_refund_the_fleet_total(spark):
    rows = [(0, north(1), 0), (180, north(2), 0),          # in: 1 km, active
            (240, north(16), 0),                           # out: removed, stored total 0
            (420, north(3), 0),                            # in: step from the pre-excursion place
            (600, north(4), 0),
            (660, north(17), 0),                           # out again
            (840, north(5), 0)]                            # in again
    out = run(spark, rows)
    assert out[0]["status"] is None                        # first ping: no stats row passes yet
    assert [r["status"] for r in out[1:]] == ["active", "removed", "active", "active", "removed", "active"]
    assert [r["area_violations"] for r in out] == [0, 0, 1, 1, 1, 2, 2]
    assert out[3]["fleet_delta_cents"] == 200 and out[3]["trip_reset"] == "removal"
    assert out[6]["fleet_delta_cents"] == 100 and out[6]["trip_reset"] == "removal"
    removals = [e["message"] for r in out for e in r["events"] if e["kind"] == "removal"]
    assert removals == [
        "[Removal Alert] Taxi Id:7 removed after exceeding 15km zone. Area violations: 1.",
        "[Removal Alert] Taxi Id:7 removed after exceeding 15km zone. Area violations: 2."]
