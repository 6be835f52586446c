"""Registry of the named queries (one per operator of the inventory).

Each query is ``(spark, sf_dir) -> DataFrame`` over the driver tables; the
matching DuckDB text is in ``oracles/catalog_sql.py``. Floating outputs are
rounded to 6 decimals with ``round6`` in both so the engines agree exactly.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import DEFAULT, FIXTURE_GRID
from .functions.geo import grid_id, round6
from .functions.num import idiv
from .operators import counters as C
from .operators import grid as G
from .operators import joins as J
from .operators import machine as X
from .operators import opsmetrics as M
from .operators import parse as P
from .operators import prep as Q
from .operators import sessions as E
from .operators import speed as S
from .operators import trips as T
from .operators import views as V
from .operators.geo_index import GeoIndex, write_geo_index
from .operators.log_ranges import append_log, newest_messages
from .operators.grid_first import grid_window_first_record
from .operators.machine_chunks import trip_chain_chunked
from .operators.speed_chunks import speed_chain_chunked
from .plans.scan import Running, keyed_scan
from .session import configure, scratch_path
from .sources import files as FS
from .sources import fixtures as FX

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


def _pings(spark, sf_dir):
    return FX.trips(spark, sf_dir)


def _fence(spark, sf_dir, cfg=DEFAULT):
    return T.fence_steps(_pings(spark, sf_dir), cfg)


def _trips(spark, sf_dir):
    return X.trip_chain(_pings(spark, sf_dir))


def _speeds(spark, sf_dir):
    return S.speed_chain(_pings(spark, sf_dir))


def _state(spark, sf_dir):
    return V.vehicle_state(_trips(spark, sf_dir), _speeds(spark, sf_dir))


def _stored(df, name):
    """A result that a plan reads twice, written once to the shared folder."""
    path = _scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------- geofence (chunked)
# a few pings per chunk: at any scale these two queries cross chunk borders
BORDERS = DEFAULT.with_(scan_chunk_rows=3)


@query("late_filter")
def q_late_filter(spark, sf_dir):
    """Per ping, whether it is accepted (not older than the newest before)."""
    return T.late_filter(_pings(spark, sf_dir)).select("taxi_id", "event_id", "ts_ms", "accepted")


@query("late_filter_chunk_borders")
def q_late_filter_chunk_borders(spark, sf_dir):
    """T3 with three pings per chunk: the carries decide."""
    return T.late_filter(_pings(spark, sf_dir), BORDERS).select("taxi_id", "event_id", "ts_ms", "accepted")


@query("distance_from_center")
def q_distance_from_center(spark, sf_dir):
    """T4: distance from the centre of every accepted ping."""
    return _fence(spark, sf_dir).filter("accepted").select(
        "taxi_id", "event_id", round6(F.col("d_center_km")).alias("d_center_km"))


@query("geofence_discard")
def q_geofence_discard(spark, sf_dir):
    """T5: the pings forwarded after dropping late ones and those beyond 15 km."""
    return _fence(spark, sf_dir).filter("forwarded").select("taxi_id", "event_id", "ts_ms", "latitude", "longitude")


@query("area_violation_count")
def q_area_violation_count(spark, sf_dir):
    """Running count of beyond-15-km pings, on each such ping."""
    return _fence(spark, sf_dir).filter("discarded").select("taxi_id", "event_id", "area_violations")


@query("geofence_transitions")
def q_geofence_transitions(spark, sf_dir):
    """Warn on crossing 10 km outwards, reset on coming back."""
    return _fence(spark, sf_dir).filter(F.col("area_event").isNotNull()).select(
        "taxi_id", "event_id", "area_event", round6(F.col("d_center_km")).alias("d_center_km"))


@query("fence_chunk_borders")
def q_fence_chunk_borders(spark, sf_dir):
    """T3-T7 with three pings per chunk: the carries decide."""
    return _fence(spark, sf_dir, BORDERS).select("taxi_id", "event_id", "accepted", "forwarded", "area_violations", "area_event")


# ------------------------------------------------- trip and status machine
@query("step_distance")
def q_step_distance(spark, sf_dir):
    """Km and whole seconds of every step within a trip."""
    return _trips(spark, sf_dir).filter("has_step").select(
        "taxi_id", "event_id", round6(F.col("step_km")).alias("step_km"), "step_s")


@query("trip_stats")
def q_trip_stats(spark, sf_dir):
    """Running trip distance (cents) and time on every forwarded ping."""
    return _trips(spark, sf_dir).filter("kind = 'forwarded'").select(
        "taxi_id", "event_id", "ts_ms", "trip_no", "total_distance_km", "total_time_s", "latitude", "longitude", "produced_ts")


IDLE_MS = 30 * 60 * 1000   # a vehicle silent for longer starts anew


@query("vehicle_sessions")
def q_vehicle_sessions(spark, sf_dir):
    """The stretches of a vehicle's pings without a gap beyond the idle limit."""
    return E.vehicle_sessions(_pings(spark, sf_dir), IDLE_MS)


@query("trip_stats_with_expiry")
def q_trip_stats_with_expiry(spark, sf_dir):
    """T1 with T3-T17 and V2: the machine whose state expires while a vehicle is idle."""
    return E.trip_chain_with_expiry(_pings(spark, sf_dir), IDLE_MS).select(
        "taxi_id", "session_start_ms", "event_id", "kind", "status", "area_violations", "halt_event",
        "total_distance_km", "total_time_s", "avg_reason", "average_speed_kmph", "stored_total")


@query("halt_detection")
def q_halt_detection(spark, sf_dir):
    """Halt after 180 cumulative still seconds, resume on a moving step."""
    return _trips(spark, sf_dir).filter(F.col("halt_event").isNotNull()).select(
        "taxi_id", "event_id", "halt_event", "still_s_total", "status")


@query("trip_resets")
def q_trip_resets(spark, sf_dir):
    """Pings after which the trip totals are cleared, and why."""
    return _trips(spark, sf_dir).filter(F.col("trip_reset").isNotNull()).select(
        "taxi_id", "event_id", "trip_reset", "total_distance_km", "total_time_s")


@query("average_speed")
def q_average_speed(spark, sf_dir):
    """Average trip speed where the gate passes (time >= 2 s, distance >= 0.01 km, <= 300 km/h)."""
    return _trips(spark, sf_dir).filter("avg_reason = 'ok'").select(
        "taxi_id", "event_id", "ts_ms", "total_distance_km", "total_time_s", "average_speed_kmph")


@query("stats_line")
def q_stats_line(spark, sf_dir):
    """The printed statistics line of each passing stats row."""
    return _trips(spark, sf_dir).filter("avg_reason = 'ok'").select("taxi_id", "event_id", F.concat(
        F.lit("Taxi ID: "), F.col("taxi_id"),
        F.lit(" | Total Distance: "), F.col("total_distance_km").cast("string"), F.lit(" km"),
        F.lit("| Average Speed: "), F.col("average_speed_kmph").cast("string"), F.lit(" km/h"),
    ).alias("line"))


@query("instant_speed")
def q_instant_speed(spark, sf_dir):
    """Speed against the anchor (last ping that passed the speed gates)."""
    return _speeds(spark, sf_dir).filter("speed_reason = 'ok'").select(
        "taxi_id", "event_id", "ts_ms", "speed_kmph", "is_speeding")


@query("instant_speed_chunk_borders")
def q_instant_speed_chunk_borders(spark, sf_dir):
    """T18/T20 with three pings per chunk and two of them read first: chunks start
    speculatively and are mended from their predecessors."""
    # the chunks' sizes and the chunks themselves both read the pings: write them once
    return speed_chain_chunked(_stored(_pings(spark, sf_dir), "pings"), BORDERS, head=2).select(
        "taxi_id", "event_id", "speed_reason", "speed_kmph", "is_speeding", "speeding_count")


@query("speeding_flag_count")
def q_speeding_flag_count(spark, sf_dir):
    """Running count of speeding outputs per vehicle, reset at trip end."""
    return _speeds(spark, sf_dir).filter("is_speeding").select("taxi_id", "event_id", "speeding_count")


@query("speed_outputs")
def q_speed_outputs(spark, sf_dir):
    """The side output of the speed operator, with the 0.5 km grid cell."""
    return _speeds(spark, sf_dir).filter("speed_reason = 'ok'").select(
        "taxi_id", "event_id", "ts_ms", "latitude", "longitude", "speed_kmph",
        grid_id(F.col("latitude"), F.col("longitude")).alias("grid_id"))


@query("speeding_alert")
def q_speeding_alert(spark, sf_dir):
    """Alert text for every speeding output."""
    return _speeds(spark, sf_dir).filter("is_speeding").select("taxi_id", "event_id", S.alert_text().alias("alert"))


@query("reject_reasons")
def q_reject_reasons(spark, sf_dir):
    """How many pings each gate dropped or skipped."""
    trip = F.explode(F.array_compact(F.array(
        F.when(F.col("kind") == "late", F.lit("out_of_order")),
        F.when(F.col("kind") == "discarded", F.lit("discarded_beyond_15km")),
        F.when(F.col("avg_reason") != "ok", F.col("avg_reason")))))
    speed = _speeds(spark, sf_dir).filter(F.col("speed_reason").isin("speed_skipped", "speed_unrealistic"))
    reasons = _trips(spark, sf_dir).select(trip.alias("reason")).unionByName(speed.select(F.col("speed_reason").alias("reason")))
    return reasons.groupBy("reason").agg(F.count("*").alias("pings"))


@query("removal_events")
def q_removal_events(spark, sf_dir):
    """Removal messages, only on a change of status to removed."""
    return (_trips(spark, sf_dir).select("taxi_id", "event_id", F.explode("events").alias("e"))
            .filter("e.kind = 'removal'").select("taxi_id", "event_id", "e.message"))


@query("status_machine")
def q_status_machine(spark, sf_dir):
    """V2: every status transition (active / inactive / halted / removed)."""
    return _trips(spark, sf_dir).filter(~F.col("status").eqNullSafe(F.col("status_before"))).select(
        "taxi_id", "event_id", "status_before", "status")


def _bordered(spark, sf_dir):
    return trip_chain_chunked(_stored(_pings(spark, sf_dir), "pings"), BORDERS)


@query("trip_stats_chunk_borders")
def q_trip_stats_chunk_borders(spark, sf_dir):
    """T11/T12/T16 with three pings per chunk: the composed states decide."""
    return _bordered(spark, sf_dir).filter("kind = 'forwarded'").select(
        "taxi_id", "event_id", "ts_ms", "trip_no", "total_distance_km", "total_time_s", "latitude", "longitude", "produced_ts")


@query("halt_detection_chunk_borders")
def q_halt_detection_chunk_borders(spark, sf_dir):
    """T13/T14 with three pings per chunk."""
    return _bordered(spark, sf_dir).filter(F.col("halt_event").isNotNull()).select(
        "taxi_id", "event_id", "halt_event", "still_s_total", "status")


@query("status_machine_chunk_borders")
def q_status_machine_chunk_borders(spark, sf_dir):
    """V2 with three pings per chunk."""
    return _bordered(spark, sf_dir).filter(~F.col("status").eqNullSafe(F.col("status_before"))).select(
        "taxi_id", "event_id", "status_before", "status")


def _trip_state(spark, sf_dir):
    """The state without its speed fields: no speed anchor needed."""
    return V.vehicle_state_partial(_trips(spark, sf_dir), V.TRIP_GROUPS).select("taxi_id", "last.*", "ok.*", "avg.*")


@query("status_counts")
def q_status_counts(spark, sf_dir):
    """V3: vehicles per final status."""
    return V.status_counts(_trip_state(spark, sf_dir))


@query("status_count_series")
def q_status_count_series(spark, sf_dir):
    """V3 over time: the four counters after every status change."""
    return C.status_count_series(C.status_changes(_trips(spark, sf_dir)))


@query("status_count_series_carry_tree")
def q_status_count_series_carry_tree(spark, sf_dir):
    """V3 over time with two summary rows a window and short chunks."""
    return C.status_count_series(C.status_changes(_trips(spark, sf_dir)), fan_out=2, chunk=64)


@query("status_members")
def q_status_members(spark, sf_dir):
    """V4: members of each status set."""
    return V.status_members(_trip_state(spark, sf_dir))


@query("fleet_distance")
def q_fleet_distance(spark, sf_dir):
    """V5: fleet-wide distance counter."""
    return V.fleet_distance(_trips(spark, sf_dir))


@query("violation_members")
def q_violation_members(spark, sf_dir):
    """V6: vehicles currently beyond 10 km or currently speeding."""
    return V.violation_members(_state(spark, sf_dir))


@query("violation_counts")
def q_violation_counts(spark, sf_dir):
    """V7: counts of V6."""
    return V.violation_counts(_state(spark, sf_dir))


@query("event_log")
def q_event_log(spark, sf_dir):
    """V8: all logged messages, newest first."""
    return V.newest_first(V.event_log(_trips(spark, sf_dir), _speeds(spark, sf_dir)))


LOG_RANGE, LOG_BATCHES, NEWEST = 256, 3, 100   # arrival keys of a range, appends, messages of the report


@query("event_log_newest")
def q_event_log_newest(spark, sf_dir):
    """The newest messages of a log appended in batches, from its last arrival ranges alone."""
    path = _scratch(spark, "log")
    events = _stored(V.event_log(_trips(spark, sf_dir), _speeds(spark, sf_dir)), "events")
    for b in range(LOG_BATCHES):   # a batch holds messages of all ranges
        append_log(events.filter(F.pmod("event_id", F.lit(LOG_BATCHES)) == b), b, path, LOG_RANGE)
    return newest_messages(spark, path, NEWEST)


@query("vehicle_current")
def q_vehicle_current(spark, sf_dir):
    """V1: current state row of every vehicle."""
    return _state(spark, sf_dir).select(
        "taxi_id", "status", "total_distance_km", "last_update_ms", "latitude", "longitude", "average_speed_kmph",
        "current_speed_kmph", "speeding", "speeding_speed_kmph", "ten_km_crossed", "area_violations")


# map rectangle of the in-bounds view (the inner city)
BOUNDS = (39.85, 116.30, 39.98, 116.50)


@query("vehicles_in_bounds")
def q_vehicles_in_bounds(spark, sf_dir):
    """V9: vehicles whose current position is inside a map rectangle."""
    return V.vehicles_in_bounds(_trip_state(spark, sf_dir), *BOUNDS).select(
        "taxi_id", "latitude", "longitude", "status")


def _geo_index(spark, sf_dir):
    """The trip state's positions as an index of small runs, so that lookups
    cross the borders of runs at every scale."""
    state = _stored(_trip_state(spark, sf_dir).select("taxi_id", "latitude", "longitude", "status"), "positions")
    path = _scratch(spark, "geo")
    write_geo_index(state, path, run_rows=64)
    return GeoIndex(spark, path, state.schema)


@query("vehicles_in_bounds_indexed")
def q_vehicles_in_bounds_indexed(spark, sf_dir):
    """The same rectangle through the geo index: only covering runs are read."""
    return _geo_index(spark, sf_dir).in_bounds(*BOUNDS)


@query("vehicles_near")
def q_vehicles_near(spark, sf_dir):
    """Vehicles at most 5 km from the centre, through the geo index."""
    return _geo_index(spark, sf_dir).near(DEFAULT.center_lat, DEFAULT.center_lon, 5.0)


@query("vehicles_nearest")
def q_vehicles_nearest(spark, sf_dir):
    """The ten vehicles nearest to the north-eastern corner of the map rectangle."""
    return _geo_index(spark, sf_dir).nearest(BOUNDS[2], BOUNDS[3], 10)


@query("vehicle_lookup")
def q_vehicle_lookup(spark, sf_dir):
    """Lookup by violation: the vehicles whose latest speed output was speeding."""
    return V.vehicle_lookup(_state(spark, sf_dir), violation="speeding").select(
        "taxi_id", "status", "current_speed_kmph", "speeding_speed_kmph")


@query("vehicle_lookup_by_status")
def q_vehicle_lookup_by_status(spark, sf_dir):
    """Lookup by status: the halted vehicles."""
    return V.vehicle_lookup(_state(spark, sf_dir), status="halted").select(
        "taxi_id", "status", "latitude", "longitude", "current_speed_kmph")


@query("vehicle_lookup_by_id")
def q_vehicle_lookup_by_id(spark, sf_dir):
    """Lookup by id: one vehicle's state row. No vehicle's state depends on
    another's pings, so the id is looked up among the pings, before both chains."""
    pings = V.vehicle_lookup(_pings(spark, sf_dir), taxi_id=7)
    return V.vehicle_state(X.trip_chain(pings), S.speed_chain(pings)).select(
        "taxi_id", "status", "total_distance_km", "average_speed_kmph", "current_speed_kmph")


@query("fleet_dashboard")
def q_fleet_dashboard(spark, sf_dir):
    """One row of dashboard figures."""
    d = V.fleet_dashboard(_state(spark, sf_dir))
    return d.select(*V.STATUSES, round6(F.col("mean_average_speed_kmph")).alias("mean_average_speed_kmph"),
                    "speeding_vehicles", "area_violation_vehicles", "driving_vehicles", "total_distance_all_km")


@query("vehicle_removed_key")
def q_vehicle_removed_key(spark, sf_dir):
    """The state after deleting the vehicles whose final status is removed."""
    # the served state (one row per vehicle) is read twice: write it once
    st = _stored(_trip_state(spark, sf_dir).select("taxi_id", "status"), "state")
    gone = st.filter(F.col("status") == "removed").select("taxi_id")
    return V.remove_vehicles(st, gone).select("taxi_id", "status")


# ------------------------------------------------------- parse and prepare
@query("parse_ping")
def q_parse_ping(spark, sf_dir):
    """Wire messages parsed to typed pings; header and bad lines dropped."""
    msgs = FX.messages(FX.trips(spark, sf_dir))
    return P.parse_pings(msgs, keep=["event_id"])


def _raw(spark, sf_dir):
    return FX.raw_pings(FX.trips(spark, sf_dir))


@query("positional_schema")
def q_positional_schema(spark, sf_dir):
    """Q1: raw rows under the fixed four-column schema (arity checked)."""
    raw = _raw(spark, sf_dir).select("taxi_id", "date_time", "longitude", "latitude", "event_id")
    return Q.positional(raw, keep=["event_id"])


@query("coerce_timestamps")
def q_coerce_timestamps(spark, sf_dir):
    """Q2: rows whose date_time parses, with the parsed time (epoch seconds)."""
    df = Q.coerce_timestamps(_raw(spark, sf_dir))
    return df.select("event_id", "taxi_id", F.unix_seconds("ts").alias("ts_s"))


@query("validate_bbox")
def q_validate_bbox(spark, sf_dir):
    """Q3: rows inside the inclusive city box (after Q2)."""
    df = Q.validate_bbox(Q.coerce_timestamps(_raw(spark, sf_dir)))
    return df.select("event_id", "taxi_id", "longitude", "latitude")


@query("add_end_flag")
def q_add_end_flag(spark, sf_dir):
    """Q4/Q5: prepared rows with end_flag = 1 on each vehicle's last row."""
    df = Q.prepare(_raw(spark, sf_dir))
    return df.select("event_id", "taxi_id", F.unix_seconds("ts").alias("ts_s"), "longitude", "latitude",
                     "end_flag")


@query("time_sort")
def q_time_sort(spark, sf_dir):
    """Q6: prepared rows in final time order."""
    df = Q.time_sort(Q.prepare(_raw(spark, sf_dir)))
    return df.select("event_id", "taxi_id", F.unix_seconds("ts").alias("ts_s"), "end_flag")


@query("drop_duplicates")
def q_drop_duplicates(spark, sf_dir):
    """Q7: distinct raw rows (library option)."""
    raw = _raw(spark, sf_dir).select(*Q.RAW_COLUMNS)
    return Q.drop_duplicates(raw)


@query("drop_nulls")
def q_drop_nulls(spark, sf_dir):
    """Q7: raw rows without nulls (library option)."""
    return Q.drop_nulls(_raw(spark, sf_dir).select("event_id", *Q.RAW_COLUMNS))


@query("prep_report")
def q_prep_report(spark, sf_dir):
    """Q8: preparation report (files, skipped files, rows per rule, columns)."""
    return Q.prep_report(_raw(spark, sf_dir), FX.file_list(spark, sf_dir))


@query("unsorted_vehicle_audit")
def q_unsorted_vehicle_audit(spark, sf_dir):
    """Q9: vehicles whose timestamps are not non-decreasing in file order."""
    return Q.unsorted_vehicles(_raw(spark, sf_dir))


@query("file_line_counts")
def q_file_line_counts(spark, sf_dir):
    """Q10: non-blank lines per listed file (0 for empty files)."""
    return Q.file_line_counts(FX.file_lines(FX.trips(spark, sf_dir)), FX.file_list(spark, sf_dir))


@query("file_line_profile")
def q_file_line_profile(spark, sf_dir):
    """Q10: file summary (totals, max, min over non-empty, files at min, mean, empty)."""
    p = Q.file_line_profile(FX.file_lines(FX.trips(spark, sf_dir)), FX.file_list(spark, sf_dir))
    return p.withColumn("avg_lines", round6(F.col("avg_lines")))


@query("order_ratio")
def q_order_ratio(spark, sf_dir):
    """Q11: in-order / out-of-order pings against the immediately preceding ping."""
    r = Q.order_ratio(FX.trips(spark, sf_dir))
    return r.select("in_order", "out_of_order", round6(F.col("in_order_pct")).alias("in_order_pct"),
                    round6(F.col("out_of_order_pct")).alias("out_of_order_pct"))


@query("replay_schedule")
def q_replay_schedule(spark, sf_dir):
    """Q12: replay batches (rows per timestamp) and the delay to the next batch."""
    # the replay reads the prepared rows; only their times matter (no end flag)
    r = Q.replay_schedule(Q.validate_bbox(Q.coerce_timestamps(_raw(spark, sf_dir))))
    return r.select(F.unix_seconds("batch_ts").alias("batch_ts_s"), "rows", "delay_s")


@query("stamp_message")
def q_stamp_message(spark, sf_dir):
    """Q13: producer text of each prepared row (produced epoch = row time)."""
    df = Q.prepare(_raw(spark, sf_dir))
    return Q.stamp_message(df, F.unix_seconds("ts")).select(
        "taxi_id", "message")


# ------------------------------------------------------------------- grid
def _grid_speeds(spark, sf_dir):
    return FX.grid_speeds(FX.trips(spark, sf_dir))


def _cells(spark, sf_dir):
    return G.grid_window(_grid_speeds(spark, sf_dir), FIXTURE_GRID)


@query("grid_id")
def q_grid_id(spark, sf_dir):
    """G1: 0.5 km cell of every forwarded ping."""
    s = _fence(spark, sf_dir).filter("forwarded")
    return G.with_grid_id(s).select("taxi_id", "event_id", "grid_id")


@query("grid_bounds")
def q_grid_bounds(spark, sf_dir):
    """Corners of every 0.5 km cell that received a forwarded ping."""
    s = _fence(spark, sf_dir).filter("forwarded")
    cells = G.with_grid_bounds(G.with_grid_id(s).select("grid_id").distinct())
    return cells.select("grid_id", *[round6(F.col(c)).alias(c) for c in
                                     ("bottom_left_lat", "bottom_left_lon", "top_right_lat", "top_right_lon")])


@query("grid_window")
def q_grid_window(spark, sf_dir):
    """Per one-day window and 5 km cell: mean latest speed and vehicle count."""
    c = _cells(spark, sf_dir)
    return c.select(F.unix_seconds(F.col("window.start")).alias("window_start_s"), "grid_id",
                    round6(F.col("avg_speed_kmph")).alias("avg_speed_kmph"), "vehicles")


@query("grid_window_first_record")
def q_grid_window_first_record(spark, sf_dir):
    """G3 as the reference opens windows: by each cell's first record, and again by
    the first one at least a window later."""
    w = grid_window_first_record(_grid_speeds(spark, sf_dir), FIXTURE_GRID)
    return w.select("grid_id", "window_start_us", round6(F.col("avg_speed_kmph")).alias("avg_speed_kmph"), "vehicles",
                    G.traffic_status(F.col("avg_speed_kmph"), F.col("vehicles")).alias("traffic_status"))


@query("traffic_status")
def q_traffic_status(spark, sf_dir):
    """Cells per traffic status."""
    c = _cells(spark, sf_dir)
    return (c.select(G.traffic_status(F.col("avg_speed_kmph"), F.col("vehicles")).alias("traffic_status"))
            .groupBy("traffic_status").agg(F.count("*").alias("cells")))


@query("grid_snapshot")
def q_grid_snapshot(spark, sf_dir):
    """Stored cell rows (bounds, mean speed, count, status, update time)."""
    snap = G.grid_snapshot(_cells(spark, sf_dir), FIXTURE_GRID)
    return snap.select("grid_id", *[round6(F.col(c)).alias(c) for c in
                                    ("bottom_left_lat", "bottom_left_lon", "top_right_lat", "top_right_lon",
                                     "avg_speed_kmph")],
                       "avg_speed_text", "vehicles", "traffic_status", F.unix_seconds("updated_at").alias("updated_at_s"))


@query("recent_grids")
def q_recent_grids(spark, sf_dir):
    """Every cell's latest snapshot, most recently updated first."""
    snap = G.grid_snapshot(_cells(spark, sf_dir), FIXTURE_GRID)
    r = G.recent_grids(snap)
    return r.select("grid_id", F.unix_seconds("updated_at").alias("updated_at_s"), "vehicles",
                    "traffic_status")


@query("grid_moves")
def q_grid_moves(spark, sf_dir):
    """Speed outputs whose 0.5 km cell differs from the vehicle's previous one."""
    sp = G.with_grid_id(_speeds(spark, sf_dir).filter("speed_reason = 'ok'"))
    return G.grid_moves(_stored(sp.select("taxi_id", "event_id", "arrival_key", "grid_id"), "speed-cells")).select("taxi_id", "event_id", "prev_grid_id", "grid_id")


# ------------------------------------------------------------- ops metrics
HOUR = 3600
# columns of the metric log
LOG_COLUMNS = ["operator_name", "latency_ms", "throughput", "cache_hits", "cache_misses", "cache_hit_ratio"]


def _req(spark, sf_dir):
    return FX.requests(spark, sf_dir)


@query("interval_metrics")
def q_interval_metrics(spark, sf_dir):
    """M1: per operator and hour: latency, throughput, errors, cache figures."""
    m = M.interval_metrics(_req(spark, sf_dir), HOUR)
    return m.select("operator_name", F.unix_seconds("interval_start").alias("interval_start_s"),
                    "latency_ms", round6(F.col("throughput")).alias("throughput"), "messages", "errors")


@query("cache_hit_ratio")
def q_cache_hit_ratio(spark, sf_dir):
    """M2: cache hit ratio per operator and hour."""
    m = M.interval_metrics(_req(spark, sf_dir), HOUR)
    return m.select("operator_name", F.unix_seconds("interval_start").alias("interval_start_s"),
                    "cache_hits", "cache_misses", round6(F.col("cache_hit_ratio")).alias("cache_hit_ratio"))


@query("endpoint_metrics")
def q_endpoint_metrics(spark, sf_dir):
    """M3: per endpoint and hour: requests, errors, mean latency, requests/s."""
    m = M.endpoint_metrics(_req(spark, sf_dir), HOUR)
    return m.select(F.unix_seconds("interval_start").alias("interval_start_s"), "endpoint", "request_count",
                    "error_count", round6(F.col("latency_ms")).alias("latency_ms"),
                    round6(F.col("req_per_sec")).alias("req_per_sec"))


@query("endpoint_status_counts")
def q_endpoint_status_counts(spark, sf_dir):
    """M3: requests per status code, endpoint and hour."""
    m = M.endpoint_status_counts(_req(spark, sf_dir), HOUR)
    return m.select(F.unix_seconds("interval_start").alias("interval_start_s"), "endpoint", "status_code", "n")


@query("flatten_endpoints")
def q_flatten_endpoints(spark, sf_dir):
    """M4: endpoint metrics flattened to <endpoint>_<metric> name/value pairs."""
    req = _req(spark, sf_dir)
    f = M.flatten_endpoints(M.endpoint_metrics(req, HOUR), M.endpoint_status_counts(req, HOUR))
    return f.select(F.unix_seconds("interval_start").alias("interval_start_s"), "name",
                    round6(F.col("value")).alias("value"))


@query("metric_series")
def q_metric_series(spark, sf_dir):
    """M5: (operator, metric, time, value) series of every column of the metric log."""
    s = M.metric_series(M.interval_metrics(_req(spark, sf_dir), HOUR).select("interval_start", *LOG_COLUMNS))
    return s.select("operator_name", "metric", F.unix_seconds("interval_start").alias("interval_start_s"),
                    round6(F.col("value")).alias("value"))


@query("error_log")
def q_error_log(spark, sf_dir):
    """M6: error log lines of the failed requests."""
    return M.error_log(_req(spark, sf_dir))


def _processed_stats(spark, sf_dir, fan_out=DEFAULT.scan_fan_out):
    """Passing stats rows with the time they were produced and processed. The
    stream's clock when a ping arrives is the newest production time among the
    pings that have arrived, so a ping that arrives late has a latency. The
    clock runs over all pings as one key, so its carries are a tree."""
    pings = _pings(spark, sf_dir).withColumn("_all", F.lit(1))
    clock = keyed_scan(pings, ["_all"], ["arrival_key", "event_id"], idiv(F.col("arrival_key"), 4096),
                       [Running("processed_us", "max", F.col("us"))], chunk_col="_achunk", fan_out=fan_out).drop("_all", "_achunk")
    return X.trip_chain(clock).filter("avg_reason = 'ok'").select(
        "taxi_id", "event_id", idiv(F.col("processed_us"), 1000).alias("processed_ms"), idiv(F.col("us"), 1000).alias("produced_ms"))


def _latency(stats):
    return stats.select("taxi_id", "event_id", (F.col("processed_ms") - F.col("produced_ms")).alias("latency_ms"))


@query("end_to_end_latency")
def q_end_to_end_latency(spark, sf_dir):
    """Latency of each written stats row, from production to processing."""
    return _latency(_processed_stats(spark, sf_dir))


@query("end_to_end_latency_carry_tree")
def q_end_to_end_latency_carry_tree(spark, sf_dir):
    """T23 with two summary rows a window: the carries come down a tree of many levels."""
    return _latency(_processed_stats(spark, sf_dir, fan_out=2))


@query("latency_metrics")
def q_latency_metrics(spark, sf_dir):
    """T23 in M1: mean latency and throughput of the stats rows per hour."""
    m = M.latency_metrics(_processed_stats(spark, sf_dir), HOUR)
    return m.select("interval_start_s", "latency_ms", round6(F.col("throughput")).alias("throughput"), "messages")


# the fixture's override of the reference's 5 s interval (FIXTURES.md)
JOIN_BOUND_MS = 30 * 60 * 1000


@query("location_speed_interval_join")
def q_location_speed_interval_join(spark, sf_dir):
    """Forwarded pings joined with the same vehicle's speeds within +-30 min."""
    pings = X.kinds(_pings(spark, sf_dir)).filter("kind = 'forwarded'").select(
        "taxi_id", "event_id", "ts_ms", "latitude", "longitude", "end_flag")
    speeds = _speeds(spark, sf_dir).filter("speed_reason = 'ok'").select(
        "taxi_id", "event_id", "ts_ms", F.col("speed_kmph").alias("kmph"), "is_speeding")
    j = J.interval_join(pings, _stored(speeds, "speeds"), JOIN_BOUND_MS)
    return j.select("taxi_id", "event_id", "speed_event_id", "ts_ms", F.col("speed_kmph"), "speed_is_speeding",
                    "end_flag", grid_id(F.col("latitude"), F.col("longitude")).alias("grid_id"))


# ------------------------------------------------ connectors (round trips)
def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("raw_csv_scan")
def q_raw_csv_scan(spark, sf_dir):
    """S3/Q1: raw rows written as headerless per-vehicle CSV files and read back
    by the raw scanner (arity checked)."""
    path = _scratch(spark, "raw")
    FS.raw_files_sink(_raw(spark, sf_dir), path)
    if FS.raw_arity(spark, path, glob="*.csv", recursive=True).first().max_fields != len(Q.RAW_COLUMNS):
        raise ValueError("unexpected number of columns in the raw files")
    df = FS.raw_csv_scan(spark, path, glob="*.csv", recursive=True)
    return df.select(*Q.RAW_COLUMNS)


@query("prepared_csv_scan")
def q_prepared_csv_scan(spark, sf_dir):
    """Prepared rows written as one time-ordered CSV with a header and read back."""
    path = _scratch(spark, "prepared")
    df = Q.prepare(_raw(spark, sf_dir)).select(
        "taxi_id", F.date_format("ts", Q.TS_PATTERN).alias("date_time"), "longitude", "latitude", "end_flag")
    FS.csv_sink(df, path, ["date_time", "taxi_id", "longitude", "latitude"])
    return FS.prepared_csv_scan(spark, path)


@query("metrics_json_scan")
def q_metrics_json_scan(spark, sf_dir):
    """Interval metrics appended as JSON lines and read back."""
    path = _scratch(spark, "metrics")
    m = M.interval_metrics(_req(spark, sf_dir), HOUR).select(
        "operator_name", F.date_format("interval_start", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        "latency_ms", "throughput", "cache_hits", "cache_misses", "cache_hit_ratio")
    FS.metrics_log_sink(m, path)
    back = FS.metrics_json_scan(spark, path)
    return back.select("operator_name", F.unix_seconds("ts").alias("interval_start_s"), "latency_ms",
                       round6(F.col("throughput")).alias("throughput"), "cache_hits", "cache_misses",
                       round6(F.col("cache_hit_ratio")).alias("cache_hit_ratio"))


@query("file_report")
def q_file_report(spark, sf_dir):
    """State and lines of every vehicle that is listed or has written raw
    files. A vehicle's lines may lie in several files; one that is listed (one
    per customer) and has none is empty."""
    path = _scratch(spark, "listed")
    vehicle = F.regexp_replace("file_name", "[.]txt$", "")
    lines = FX.file_lines(FX.trips(spark, sf_dir)).select(F.col("line").alias("value"), vehicle.alias("vehicle"))
    FS.line_files_sink(lines, path)
    parts = FS.file_report(spark, path + "/*", glob="*.txt").withColumn("vehicle", F.regexp_extract("file_path", "/vehicle=([^/]+)/", 1))
    listed = FX.file_list(spark, sf_dir).select(vehicle.alias("vehicle"))
    return FS.vehicle_report(listed, parts)


# ------------------------------------------------------ the live path
REPLAY_STEPS = 3   # runs of the stream over what has arrived so far


def _replayed(spark, sf_dir):
    from .streaming.live import replay_vehicle_stream
    root = _scratch(spark, "replay")
    replay_vehicle_stream(FX.messages(FX.trips(spark, sf_dir)), root, REPLAY_STEPS)
    return root


@query("vehicle_stream_replay")
def q_vehicle_stream_replay(spark, sf_dir):
    """S1/S2/T1 + the stateful machine in Structured Streaming: wire messages
    arrive in several parts, each taken by a run of the stream that goes on from
    the checkpoint; the per-ping outputs read back."""
    out = spark.read.parquet(f"{_replayed(spark, sf_dir)}/out/pings")
    return out.select("taxi_id", "event_id", "kind", "status", "area_violations", "halt_event",
                      "total_distance_km", "total_time_s", "avg_reason", "average_speed_kmph",
                      "speed_reason", "speed_kmph", "speeding_count", "stored_total")


@query("vehicle_state_stream_replay")
def q_vehicle_state_stream_replay(spark, sf_dir):
    """The served vehicle state after the replayed stream, merged
    from the partial states its sink appended."""
    from .streaming.sinks import read_vehicle_state
    st = read_vehicle_state(spark, f"{_replayed(spark, sf_dir)}/out")
    return st.select("taxi_id", "status", "total_distance_km", "last_update_ms", "average_speed_kmph",
                     "current_speed_kmph", "speeding", "speeding_speed_kmph", "ten_km_crossed", "area_violations",
                     (F.col("fleet_cents") / 100.0).alias("fleet_km"))


@query("event_log_stream_replay")
def q_event_log_stream_replay(spark, sf_dir):
    """The event log the replayed stream appended."""
    return spark.read.parquet(f"{_replayed(spark, sf_dir)}/out/events").select(
        "taxi_id", "event_id", "arrival_key", "sub", "kind", "message")


@query("status_count_series_stream_replay")
def q_status_count_series_stream_replay(spark, sf_dir):
    """V3 over time from the status changes the replayed stream appended."""
    changes = spark.read.parquet(f"{_replayed(spark, sf_dir)}/out/status_changes").drop("batch_id")
    return C.status_count_series(changes)


EXPIRY_STEPS = 2
EXPIRY_WATERMARK = "30 minutes"   # pings of this query arrive up to five places late


@query("vehicle_expiry_stream_replay")
def q_vehicle_expiry_stream_replay(spark, sf_dir):
    """T1 live: event-time timers flush idle vehicles and give up their state.
    Outputs of every ping and a row for every session that has ended, whether by
    its timer or by a ping beyond the limit."""
    from .streaming.expiry import expiring_vehicle_stream, session_sinks
    from .streaming.live import replay_vehicle_stream
    root = _scratch(spark, "expiry")
    late = F.when(F.pmod("event_id", F.lit(17)) == 0, 5).otherwise(0)
    messages = FX.messages(FX.trips(spark, sf_dir)).withColumn("arrival_key", F.col("event_id") + late)
    replay_vehicle_stream(messages, root, EXPIRY_STEPS, stream=lambda m: expiring_vehicle_stream(m, IDLE_MS, EXPIRY_WATERMARK),
                          sinks=session_sinks)
    return spark.read.parquet(f"{root}/out/sessions").select(
        "taxi_id", "session_start_ms", "event_id", "ts_ms", "kind", "status", "area_violations", "total_distance_km",
        "total_time_s", "avg_reason", "speed_reason", "speed_kmph", "speeding_count", "stored_total")


@query("location_speed_join_stream_replay")
def q_location_speed_join_stream_replay(spark, sf_dir):
    """T25 live: the replayed per-ping outputs joined stream-to-stream (same
    vehicle, speed within +-30 min of the ping), written and read back."""
    from .streaming.live import finish, location_speed_join_stream
    root = _replayed(spark, sf_dir)
    schema = spark.read.parquet(f"{root}/out/pings").schema
    a, b = (spark.readStream.schema(schema).parquet(f"{root}/out/pings") for _ in range(2))
    j = location_speed_join_stream(a, b, JOIN_BOUND_MS, watermark="2 hours")
    finish(j.writeStream.format("parquet").option("path", f"{root}/pairs")
           .option("checkpointLocation", f"{root}/pairs_checkpoint"))
    return spark.read.parquet(f"{root}/pairs").select(
        "taxi_id", "event_id", "speed_event_id", "ts_ms", "speed_kmph", "speed_is_speeding", "end_flag")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
