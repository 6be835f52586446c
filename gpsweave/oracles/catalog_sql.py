"""DuckDB oracle text for each registered query (same names, same columns)."""

from __future__ import annotations

from ..config import DEFAULT
from ..config import FIXTURE_GRID
from .fixtures_sql import FILE_LINES, GRID_SPEEDS, MESSAGES, RAW_PINGS, REQUESTS, TRIPS, with_
from .lifecycle_sql import lifecycle_ctes
from .trips_sql import W_EXC, W_INC, hav_sql, r6, steps_ctes

ORACLES: dict[str, str] = {}


def grid_id_sql(cfg, lat="latitude", lon="longitude") -> str:
    return (f"concat(CAST(trunc(({lat} - {cfg.grid_min_lat!r}::DOUBLE) / {cfg.lat_delta!r}::DOUBLE) AS INTEGER), '_', "
            f"CAST(trunc(({lon} - {cfg.grid_min_lon!r}::DOUBLE) / {cfg.lon_delta!r}::DOUBLE) AS INTEGER))")


def bounds_sql(cfg, gid="grid_id") -> str:
    la = f"CAST(split_part({gid}, '_', 1) AS INTEGER)"
    lo = f"CAST(split_part({gid}, '_', 2) AS INTEGER)"
    bl_lat = f"({cfg.grid_min_lat!r}::DOUBLE + {la} * {cfg.lat_delta!r}::DOUBLE)"
    bl_lon = f"({cfg.grid_min_lon!r}::DOUBLE + {lo} * {cfg.lon_delta!r}::DOUBLE)"
    return (f"{r6(bl_lat)} AS bottom_left_lat, {r6(bl_lon)} AS bottom_left_lon, "
            f"{r6(f'{bl_lat} + {cfg.lat_delta!r}::DOUBLE')} AS top_right_lat, "
            f"{r6(f'{bl_lon} + {cfg.lon_delta!r}::DOUBLE')} AS top_right_lon")




def _steps_query(select: str) -> str:
    return f"{with_(TRIPS, steps_ctes('trips', DEFAULT))}\n{select}"


ORACLES["late_filter"] = _steps_query("SELECT taxi_id, event_id, ts_ms, accepted FROM steps")
ORACLES["distance_from_center"] = _steps_query(
    f"SELECT taxi_id, event_id, {r6('d_center_km')} AS d_center_km FROM steps WHERE accepted")
ORACLES["geofence_discard"] = _steps_query(
    "SELECT taxi_id, event_id, ts_ms, latitude, longitude FROM steps WHERE forwarded")
ORACLES["area_violation_count"] = _steps_query(
    "SELECT taxi_id, event_id, CAST(area_violations AS BIGINT) AS area_violations FROM steps WHERE discarded")
ORACLES["geofence_transitions"] = _steps_query(
    f"SELECT taxi_id, event_id, area_event, {r6('d_center_km')} AS d_center_km FROM steps "
    "WHERE area_event IS NOT NULL")
ORACLES["late_filter_chunk_borders"] = ORACLES["late_filter"]
ORACLES["fence_chunk_borders"] = _steps_query(
    "SELECT taxi_id, event_id, accepted, forwarded, CAST(area_violations AS BIGINT) AS area_violations, area_event FROM steps")


def _lc_query(select: str) -> str:
    return f"{with_(TRIPS, lifecycle_ctes('trips', DEFAULT))},\n{STATE}\n{select}"


# one row per vehicle, as ``views.vehicle_state``
STATE = """
state AS (
  SELECT taxi_id,
         arg_max(status, k) AS status, arg_max(stored_total, k) AS total_distance_km,
         arg_max(warned, k) AS ten_km_crossed, arg_max(area_violations, k) AS area_violations,
         arg_max(ts_ms, k) FILTER (WHERE avg_reason = 'ok') AS last_update_ms,
         arg_max(latitude, k) FILTER (WHERE avg_reason = 'ok') AS latitude,
         arg_max(longitude, k) FILTER (WHERE avg_reason = 'ok') AS longitude,
         arg_max(average_speed_kmph, k) FILTER (WHERE avg_reason = 'ok' AND average_speed_kmph > 0)
           AS average_speed_kmph,
         arg_max(speed_kmph, k) FILTER (WHERE speed_reason = 'ok') AS current_speed_kmph,
         arg_max(is_speeding, k) FILTER (WHERE speed_reason = 'ok') AS speeding,
         CASE WHEN arg_max(is_speeding, k) FILTER (WHERE speed_reason = 'ok')
              THEN arg_max(speed_kmph, k) FILTER (WHERE speed_reason = 'ok') END AS speeding_speed_kmph,
         sum(fleet_delta_cents) / 100.0::DOUBLE AS fleet_km
  FROM lc GROUP BY taxi_id)"""


ORACLES["instant_speed"] = _lc_query(
    "SELECT taxi_id, event_id, ts_ms, speed_kmph, is_speeding FROM lc WHERE speed_reason = 'ok'")
ORACLES["instant_speed_chunk_borders"] = _lc_query(
    "SELECT taxi_id, event_id, speed_reason, speed_kmph, is_speeding, speeding_count FROM lc WHERE kind = 'forwarded'")
ORACLES["speeding_flag_count"] = _lc_query(
    "SELECT taxi_id, event_id, speeding_count FROM lc WHERE is_speeding")
ORACLES["speed_outputs"] = _lc_query(
    f"SELECT taxi_id, event_id, ts_ms, latitude, longitude, speed_kmph, {grid_id_sql(DEFAULT)} AS grid_id "
    "FROM lc WHERE speed_reason = 'ok'")
ORACLES["speeding_alert"] = _lc_query(
    "SELECT taxi_id, event_id, concat('Speeding Alert! TaxiID=', taxi_id, ' | Speed=', "
    "CAST(speed_kmph AS VARCHAR), ' km/h') AS alert FROM lc WHERE is_speeding")
ORACLES["reject_reasons"] = _lc_query("""
SELECT reason, count(*) AS pings FROM (
  SELECT CASE WHEN kind = 'late' THEN 'out_of_order' END AS reason FROM lc
  UNION ALL SELECT CASE WHEN kind = 'discarded' THEN 'discarded_beyond_15km' END FROM lc
  UNION ALL SELECT CASE WHEN avg_reason <> 'ok' THEN avg_reason END FROM lc
  UNION ALL SELECT CASE WHEN speed_reason IN ('speed_skipped', 'speed_unrealistic') THEN speed_reason END FROM lc
) r WHERE reason IS NOT NULL GROUP BY reason""")
ORACLES["removal_events"] = _lc_query(
    "SELECT taxi_id, event_id, message FROM lc_events WHERE kind = 'removal'")
ORACLES["trip_resets"] = _lc_query(
    "SELECT taxi_id, event_id, trip_reset, total_distance_km, total_time_s FROM lc WHERE trip_reset IS NOT NULL")
ORACLES["step_distance"] = _lc_query(
    f"SELECT taxi_id, event_id, {r6('step_km')} AS step_km, step_s FROM lc WHERE step_km IS NOT NULL")
ORACLES["trip_stats"] = _lc_query(
    "SELECT taxi_id, event_id, ts_ms, trip_no, total_distance_km, total_time_s, latitude, longitude, produced_ts FROM ("
    "SELECT *, CAST(count(trip_reset) OVER (PARTITION BY taxi_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) "
    "AS BIGINT) AS trip_no FROM lc) t WHERE kind = 'forwarded'")
ORACLES["halt_detection"] = _lc_query(
    "SELECT taxi_id, event_id, halt_event, s_halt_s AS still_s_total, status FROM lc WHERE halt_event IS NOT NULL")
ORACLES["average_speed"] = _lc_query(
    "SELECT taxi_id, event_id, ts_ms, total_distance_km, total_time_s, average_speed_kmph "
    "FROM lc WHERE avg_reason = 'ok'")
ORACLES["stats_line"] = _lc_query(
    "SELECT taxi_id, event_id, concat('Taxi ID: ', taxi_id, ' | Total Distance: ', "
    "CAST(total_distance_km AS VARCHAR), ' km', '| Average Speed: ', CAST(average_speed_kmph AS VARCHAR), ' km/h') AS line "
    "FROM lc WHERE avg_reason = 'ok'")
ORACLES["status_machine"] = _lc_query(
    "SELECT taxi_id, event_id, status_before, status FROM lc WHERE status IS DISTINCT FROM status_before")
for _name in ("trip_stats", "halt_detection", "status_machine"):   # the same results from chunks of three pings
    ORACLES[f"{_name}_chunk_borders"] = ORACLES[_name]
ORACLES["status_counts"] = _lc_query(
    "SELECT status, count(*) AS vehicles FROM state WHERE status IS NOT NULL GROUP BY status")
_SERIES = "SELECT taxi_id, event_id, arrival_key, status_before, status, " + ", ".join(
    f"CAST(sum(CASE WHEN status = '{_s}' THEN 1 ELSE 0 END - CASE WHEN status_before = '{_s}' THEN 1 ELSE 0 END) "
    f"OVER (ORDER BY arrival_key, event_id, taxi_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS {_s}"
    for _s in ("active", "inactive", "halted", "removed")) + " FROM lc WHERE status IS DISTINCT FROM status_before"
for _name in ("status_count_series", "status_count_series_carry_tree"):
    ORACLES[_name] = _lc_query(_SERIES)
ORACLES["status_members"] = _lc_query("SELECT status, taxi_id FROM state WHERE status IS NOT NULL")
ORACLES["fleet_distance"] = _lc_query(
    "SELECT sum(fleet_delta_cents) / 100.0::DOUBLE AS total_distance_all_km FROM lc")
ORACLES["violation_members"] = _lc_query(
    "SELECT taxi_id, coalesce(ten_km_crossed, false) AS area_10km, coalesce(speeding, false) AS speeding "
    "FROM state WHERE coalesce(ten_km_crossed, false) OR coalesce(speeding, false)")
ORACLES["violation_counts"] = _lc_query(
    "SELECT count(*) FILTER (WHERE coalesce(speeding, false)) AS speeding_vehicles, "
    "count(*) FILTER (WHERE coalesce(ten_km_crossed, false)) AS area_violation_vehicles "
    "FROM state WHERE coalesce(ten_km_crossed, false) OR coalesce(speeding, false)")
ORACLES["event_log"] = _lc_query("SELECT taxi_id, event_id, arrival_key, sub, kind, message FROM lc_events")
ORACLES["event_log_newest"] = _lc_query("SELECT taxi_id, event_id, arrival_key, sub, kind, message FROM lc_events "
                                        "ORDER BY arrival_key DESC, event_id DESC, sub DESC LIMIT 100")
ORACLES["vehicle_current"] = _lc_query(
    "SELECT taxi_id, status, total_distance_km, last_update_ms, latitude, longitude, average_speed_kmph, "
    "current_speed_kmph, speeding, speeding_speed_kmph, ten_km_crossed, area_violations FROM state")
ORACLES["vehicles_in_bounds"] = _lc_query(
    "SELECT taxi_id, latitude, longitude, status FROM state "
    "WHERE latitude BETWEEN 39.85::DOUBLE AND 39.98::DOUBLE AND longitude BETWEEN 116.30::DOUBLE AND 116.50::DOUBLE")
ORACLES["vehicles_in_bounds_indexed"] = ORACLES["vehicles_in_bounds"]
_NEAR = ("SELECT taxi_id, latitude, longitude, status, distance_km FROM (SELECT *, {d} AS distance_km FROM state "
         "WHERE latitude IS NOT NULL AND longitude IS NOT NULL) n ")
ORACLES["vehicles_near"] = _lc_query(_NEAR.format(d=r6(hav_sql(
    f"{DEFAULT.center_lat!r}::DOUBLE", f"{DEFAULT.center_lon!r}::DOUBLE", "latitude", "longitude"))) + "WHERE distance_km <= 5")
ORACLES["vehicles_nearest"] = _lc_query(_NEAR.format(d=r6(hav_sql(
    "39.98::DOUBLE", "116.50::DOUBLE", "latitude", "longitude"))) + "ORDER BY distance_km, taxi_id LIMIT 10")
ORACLES["vehicle_lookup"] = _lc_query(
    "SELECT taxi_id, status, current_speed_kmph, speeding_speed_kmph FROM state WHERE coalesce(speeding, false)")
ORACLES["vehicle_lookup_by_status"] = _lc_query(
    "SELECT taxi_id, status, latitude, longitude, current_speed_kmph FROM state WHERE status = 'halted'")
ORACLES["vehicle_lookup_by_id"] = _lc_query(
    "SELECT taxi_id, status, total_distance_km, average_speed_kmph, current_speed_kmph FROM state WHERE taxi_id = '7'")
ORACLES["fleet_dashboard"] = _lc_query(
    "SELECT count(*) FILTER (WHERE status = 'active') AS active, count(*) FILTER (WHERE status = 'inactive') AS inactive, "
    "count(*) FILTER (WHERE status = 'halted') AS halted, count(*) FILTER (WHERE status = 'removed') AS removed, "
    f"{r6('(sum(CAST(floor(average_speed_kmph * 100 + 0.5) AS BIGINT)) / count(average_speed_kmph)) / 100.0::DOUBLE')} AS mean_average_speed_kmph, "
    "count(*) FILTER (WHERE coalesce(speeding, false)) AS speeding_vehicles, "
    "count(*) FILTER (WHERE coalesce(ten_km_crossed, false)) AS area_violation_vehicles, "
    "count(*) FILTER (WHERE status = 'active' AND current_speed_kmph > 0) AS driving_vehicles, "
    "sum(CAST(floor(fleet_km * 100 + 0.5) AS BIGINT)) / 100.0::DOUBLE AS total_distance_all_km FROM state")
ORACLES["vehicle_removed_key"] = _lc_query(
    "SELECT taxi_id, status FROM state WHERE taxi_id NOT IN (SELECT taxi_id FROM state WHERE status = 'removed')")


# ------------------------------------------------------- parse and prepare
ORACLES["parse_ping"] = f"""{with_(TRIPS, MESSAGES)}
SELECT * FROM (
  SELECT event_id, f[1] AS taxi_id,
         epoch_ms(try_strptime(f[2], '%Y-%m-%d %H:%M:%S')) AS ts_ms,
         TRY_CAST(f[4] AS DOUBLE) AS latitude, TRY_CAST(f[3] AS DOUBLE) AS longitude,
         (trim(f[5]) = '1' OR lower(trim(f[5])) = 'true') AS end_flag,
         TRY_CAST(f[6] AS DOUBLE) AS produced_ts
  FROM (SELECT event_id, string_split(message, ',') AS f FROM messages WHERE NOT starts_with(message, 'taxi_id')) m
) p WHERE taxi_id IS NOT NULL AND ts_ms IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
      AND end_flag IS NOT NULL AND produced_ts IS NOT NULL AND isfinite(latitude) AND isfinite(longitude)"""

TSP = "try_strptime(date_time, '%Y-%m-%d %H:%M:%S')"
BBOX = "coalesce(longitude BETWEEN 110.0 AND 125.0 AND latitude BETWEEN 35.0 AND 45.0, false)"
PREPARED = f"""
_ts AS (SELECT *, {TSP} AS ts FROM raw_pings WHERE {TSP} IS NOT NULL),
prepared AS (
  SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY taxi_id ORDER BY ts DESC, arrival_key DESC, event_id DESC) = 1
                 THEN 1 ELSE 0 END AS end_flag
  FROM _ts WHERE {BBOX})"""


def _raw_query(select: str, *extra: str) -> str:
    return f"{with_(TRIPS, RAW_PINGS, *extra)}\n{select}"


ORACLES["positional_schema"] = _raw_query("SELECT taxi_id, date_time, longitude, latitude, event_id FROM raw_pings")
ORACLES["coerce_timestamps"] = _raw_query(
    f"SELECT event_id, taxi_id, epoch({TSP})::BIGINT AS ts_s FROM raw_pings WHERE {TSP} IS NOT NULL")
ORACLES["validate_bbox"] = _raw_query(
    f"SELECT event_id, taxi_id, longitude, latitude FROM raw_pings WHERE {TSP} IS NOT NULL AND {BBOX}")
ORACLES["add_end_flag"] = _raw_query(
    "SELECT event_id, taxi_id, epoch(ts)::BIGINT AS ts_s, longitude, latitude, end_flag FROM prepared", PREPARED)
ORACLES["time_sort"] = _raw_query(
    "SELECT event_id, taxi_id, epoch(ts)::BIGINT AS ts_s, end_flag FROM prepared", PREPARED)
ORACLES["drop_duplicates"] = _raw_query("SELECT DISTINCT taxi_id, date_time, longitude, latitude FROM raw_pings")
ORACLES["drop_nulls"] = _raw_query(
    "SELECT event_id, taxi_id, date_time, longitude, latitude FROM raw_pings "
    "WHERE taxi_id IS NOT NULL AND date_time IS NOT NULL AND longitude IS NOT NULL AND latitude IS NOT NULL")
ORACLES["prep_report"] = f"""{with_(TRIPS, RAW_PINGS, FILE_LINES)}
SELECT r.*, f.*, 4 AS cols_before, 5 AS cols_after FROM
 (SELECT count(*) AS rows_before, count(*) FILTER (WHERE {TSP} IS NULL) AS rows_bad_timestamp,
         count(*) FILTER (WHERE {TSP} IS NOT NULL AND NOT {BBOX}) AS rows_outside_bbox,
         count(*) FILTER (WHERE {TSP} IS NOT NULL AND {BBOX}) AS rows_after FROM raw_pings) r,
 (SELECT count(*) AS files, count(*) FILTER (WHERE n IS NULL) AS files_skipped_empty
  FROM file_list l LEFT JOIN (SELECT concat('veh_', taxi_id, '.txt') AS file_name, count(*) AS n
                              FROM raw_pings GROUP BY 1) c USING (file_name)) f"""
ORACLES["unsorted_vehicle_audit"] = _raw_query(f"""
SELECT DISTINCT taxi_id FROM (
  SELECT taxi_id, ts, lag(ts) OVER (PARTITION BY taxi_id ORDER BY arrival_key, event_id) AS prev_ts
  FROM (SELECT *, {TSP} AS ts FROM raw_pings WHERE {TSP} IS NOT NULL) v) x
WHERE prev_ts > ts""")
LINE_COUNTS = """
_lines AS (SELECT l.file_name, coalesce(c.lines, 0)::BIGINT AS lines FROM file_list l
           LEFT JOIN (SELECT file_name, count(*) AS lines FROM file_lines WHERE length(trim(line)) > 0 GROUP BY 1) c
           USING (file_name))"""
ORACLES["file_line_counts"] = f"{with_(TRIPS, FILE_LINES, LINE_COUNTS)}\nSELECT file_name, lines FROM _lines"
ORACLES["file_line_profile"] = f"""{with_(TRIPS, FILE_LINES, LINE_COUNTS)},
_s AS (SELECT count(*) AS total_files, sum(lines) AS total_lines, max(lines) AS max_lines,
              coalesce(min(lines) FILTER (WHERE lines > 0), 0) AS min_lines,
              count(*) FILTER (WHERE lines = 0) AS empty_files FROM _lines)
SELECT total_files, CAST(total_lines AS BIGINT) AS total_lines, max_lines, min_lines,
       (SELECT count(*) FROM _lines WHERE lines = _s.min_lines) AS files_at_min,
       {r6('CAST(total_lines AS DOUBLE) / total_files')} AS avg_lines, empty_files FROM _s"""
ORACLES["order_ratio"] = f"""{with_(TRIPS)},
_o AS (SELECT ts_ms, lag(ts_ms) OVER (PARTITION BY taxi_id ORDER BY arrival_key, event_id) AS p FROM trips),
_c AS (SELECT count(*) FILTER (WHERE p IS NULL OR ts_ms >= p) AS in_order,
              count(*) FILTER (WHERE NOT (p IS NULL OR ts_ms >= p)) AS out_of_order FROM _o)
SELECT in_order, out_of_order, {r6('in_order * 100.0::DOUBLE / (in_order + out_of_order)')} AS in_order_pct,
       {r6('out_of_order * 100.0::DOUBLE / (in_order + out_of_order)')} AS out_of_order_pct FROM _c"""
ORACLES["replay_schedule"] = _raw_query("""
SELECT epoch(ts)::BIGINT AS batch_ts_s, rows, (epoch(lead(ts) OVER (ORDER BY ts)) - epoch(ts))::BIGINT AS delay_s
FROM (SELECT ts, count(*) AS rows FROM prepared GROUP BY ts) g""", PREPARED)
ORACLES["stamp_message"] = _raw_query("""
SELECT taxi_id, concat_ws(',', taxi_id, strftime(ts, '%Y-%m-%d %H:%M:%S'), CAST(longitude AS VARCHAR),
       CAST(latitude AS VARCHAR), CAST(end_flag AS VARCHAR), CAST(epoch(ts)::BIGINT AS VARCHAR)) AS message
FROM prepared""", PREPARED)


# ------------------------------------------------------------------- grid
FG = FIXTURE_GRID
CELLS = f"""
_gl AS (SELECT (epoch_us(ts) // 86400000000) * 86400 AS window_start_s, {grid_id_sql(FG)} AS grid_id, taxi_id,
               speed_kmph, ROW_NUMBER() OVER (PARTITION BY (epoch_us(ts) // 86400000000), {grid_id_sql(FG)}, taxi_id
                                              ORDER BY ts DESC, event_id DESC) AS rn
        FROM grid_speeds),
cells AS (SELECT window_start_s, grid_id,
                 (sum(floor(speed_kmph * 1000000.0::DOUBLE + 0.5)) / count(*)) / 1000000.0::DOUBLE AS avg_speed_kmph,
                 count(*) AS vehicles
          FROM _gl WHERE rn = 1 GROUP BY window_start_s, grid_id),
snap AS (SELECT *, CASE WHEN avg_speed_kmph < 5.0 AND vehicles >= 3 THEN 'CONGESTED'
                        WHEN avg_speed_kmph < 15.0 AND vehicles >= 3 THEN 'MODERATE'
                        WHEN avg_speed_kmph < 10.0 AND vehicles >= 2 THEN 'MODERATE' ELSE 'FREE_FLOW' END
                        AS traffic_status, window_start_s + 86400 AS updated_at_s FROM cells)"""


def _grid_query(select: str) -> str:
    return f"{with_(TRIPS, GRID_SPEEDS, CELLS)}\n{select}"


ORACLES["grid_id"] = _steps_query(f"SELECT taxi_id, event_id, {grid_id_sql(DEFAULT)} AS grid_id FROM steps WHERE forwarded")
ORACLES["grid_bounds"] = _steps_query(
    f"SELECT grid_id, {bounds_sql(DEFAULT)} FROM (SELECT DISTINCT {grid_id_sql(DEFAULT)} AS grid_id FROM steps "
    "WHERE forwarded) g")
ORACLES["grid_window"] = _grid_query(
    f"SELECT window_start_s, grid_id, {r6('avg_speed_kmph')} AS avg_speed_kmph, vehicles FROM cells")
ORACLES["grid_window_first_record"] = f"""{with_(TRIPS, GRID_SPEEDS)},
_r AS (SELECT {grid_id_sql(FG)} AS grid_id, epoch_us(ts) AS us, taxi_id, event_id, speed_kmph FROM grid_speeds),
_n AS (SELECT grid_id, us, min(us) OVER (PARTITION BY grid_id ORDER BY us RANGE BETWEEN 86400000000 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
       FROM (SELECT DISTINCT grid_id, us FROM _r) t),
_w AS (SELECT grid_id, min(us) AS start FROM _r GROUP BY grid_id
       UNION ALL SELECT w.grid_id, n.nxt FROM _w w JOIN _n n ON n.grid_id = w.grid_id AND n.us = w.start WHERE n.nxt IS NOT NULL),
_l AS (SELECT r.grid_id, w.start, speed_kmph,
              row_number() OVER (PARTITION BY r.grid_id, w.start, taxi_id ORDER BY us DESC, event_id DESC) AS rn
       FROM _r r JOIN _w w ON w.grid_id = r.grid_id AND r.us >= w.start AND r.us < w.start + 86400000000),
_c AS (SELECT grid_id, start AS window_start_us, (sum(floor(speed_kmph * 1000000.0::DOUBLE + 0.5)) / count(*)) / 1000000.0::DOUBLE AS a,
              count(*) AS vehicles FROM _l WHERE rn = 1 GROUP BY ALL)
SELECT grid_id, window_start_us, {r6('a')} AS avg_speed_kmph, vehicles,
       CASE WHEN a < 5.0 AND vehicles >= 3 THEN 'CONGESTED' WHEN a < 15.0 AND vehicles >= 3 THEN 'MODERATE'
            WHEN a < 10.0 AND vehicles >= 2 THEN 'MODERATE' ELSE 'FREE_FLOW' END AS traffic_status FROM _c"""
ORACLES["traffic_status"] = _grid_query("SELECT traffic_status, count(*) AS cells FROM snap GROUP BY 1")
ORACLES["grid_snapshot"] = _grid_query(
    f"SELECT grid_id, {bounds_sql(FG)}, {r6('avg_speed_kmph')} AS avg_speed_kmph, CAST(CAST(round(CAST(CAST(avg_speed_kmph AS VARCHAR) AS DECIMAL(30, 17)), 2) AS DECIMAL(18, 2)) AS VARCHAR) AS avg_speed_text, "
    "vehicles, traffic_status, updated_at_s FROM snap")
ORACLES["recent_grids"] = _grid_query("""
SELECT grid_id, updated_at_s, vehicles, traffic_status FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY grid_id ORDER BY updated_at_s DESC) AS rn FROM snap) s
WHERE rn = 1""")
ORACLES["grid_moves"] = _lc_query(f"""
SELECT taxi_id, event_id, prev_grid_id, grid_id FROM (
  SELECT taxi_id, event_id, {grid_id_sql(DEFAULT)} AS grid_id,
         lag({grid_id_sql(DEFAULT)}) OVER (PARTITION BY taxi_id ORDER BY k) AS prev_grid_id
  FROM lc WHERE speed_reason = 'ok') m
WHERE prev_grid_id IS NOT NULL AND prev_grid_id <> grid_id""")


# ------------------------------------------------------------- ops metrics
def _req_query(select: str) -> str:
    return f"{with_(REQUESTS)},\n" + """
_m AS (SELECT endpoint AS operator_name, (ts_us // 3600000000) * 3600 AS interval_start_s,
              sum(CAST(floor(latency_s * 1000000.0::DOUBLE + 0.5) AS BIGINT)) FILTER (WHERE NOT is_error)
                / nullif(count(*) FILTER (WHERE NOT is_error), 0) AS _lat,
              count(*) FILTER (WHERE NOT is_error) AS messages, count(*) FILTER (WHERE is_error) AS errors,
              count(*) FILTER (WHERE cache_hit) AS cache_hits, count(*) FILTER (WHERE NOT cache_hit) AS cache_misses
       FROM requests GROUP BY 1, 2),
_e AS (SELECT (ts_us // 3600000000) * 3600 AS interval_start_s, endpoint,
              count(*) FILTER (WHERE NOT is_error) AS request_count, count(*) FILTER (WHERE is_error) AS error_count,
              coalesce(sum(CAST(floor(latency_s * 1000000.0::DOUBLE + 0.5) AS BIGINT)) FILTER (WHERE NOT is_error)
                / nullif(count(*) FILTER (WHERE NOT is_error), 0) / 1000, 0.0) AS latency_ms
       FROM requests GROUP BY 1, 2),
_sc AS (SELECT (ts_us // 3600000000) * 3600 AS interval_start_s, endpoint, CAST(status_code AS VARCHAR) AS status_code,
               count(*) AS n FROM requests GROUP BY 1, 2, 3)
""" + select


M_LAT = "coalesce(floor(_lat / 1000 * 100 + 0.5) / 100, 0.0)"
ORACLES["interval_metrics"] = _req_query(
    f"SELECT operator_name, interval_start_s, {M_LAT} AS latency_ms, {r6('messages / 3600.0::DOUBLE')} AS throughput, "
    "messages, errors FROM _m")
ORACLES["cache_hit_ratio"] = _req_query(
    f"SELECT operator_name, interval_start_s, cache_hits, cache_misses, "
    f"{r6('CAST(cache_hits AS DOUBLE) / nullif(cache_hits + cache_misses, 0)')} AS cache_hit_ratio FROM _m")
ORACLES["endpoint_metrics"] = _req_query(
    f"SELECT interval_start_s, endpoint, request_count, error_count, {r6('latency_ms')} AS latency_ms, "
    f"{r6('request_count / 3600.0::DOUBLE')} AS req_per_sec FROM _e")
ORACLES["endpoint_status_counts"] = _req_query("SELECT interval_start_s, endpoint, status_code, n FROM _sc")
ORACLES["flatten_endpoints"] = _req_query(f"""
SELECT interval_start_s, name, {r6('value')} AS value FROM (
  SELECT interval_start_s, concat(endpoint, '_request_count') AS name, CAST(request_count AS DOUBLE) AS value FROM _e
  UNION ALL SELECT interval_start_s, concat(endpoint, '_error_count'), CAST(error_count AS DOUBLE) FROM _e
  UNION ALL SELECT interval_start_s, concat(endpoint, '_latency_ms'), latency_ms FROM _e
  UNION ALL SELECT interval_start_s, concat(endpoint, '_req_per_sec'), request_count / 3600.0::DOUBLE FROM _e
  UNION ALL SELECT interval_start_s, concat(endpoint, '_', status_code), CAST(n AS DOUBLE) FROM _sc) f""")
ORACLES["metric_series"] = _req_query(f"""
SELECT operator_name, metric, interval_start_s, {r6('value')} AS value FROM (
  SELECT operator_name, 'latency_ms' AS metric, interval_start_s, {M_LAT} AS value FROM _m
  UNION ALL SELECT operator_name, 'throughput', interval_start_s, messages / 3600.0::DOUBLE FROM _m
  UNION ALL SELECT operator_name, 'cache_hits', interval_start_s, CAST(cache_hits AS DOUBLE) FROM _m
  UNION ALL SELECT operator_name, 'cache_misses', interval_start_s, CAST(cache_misses AS DOUBLE) FROM _m
  UNION ALL SELECT operator_name, 'cache_hit_ratio', interval_start_s,
                   CAST(cache_hits AS DOUBLE) / nullif(cache_hits + cache_misses, 0) FROM _m) s""")
ORACLES["error_log"] = f"""{with_(REQUESTS)}
SELECT event_id, endpoint, printf('[%s] ERROR (%s): status %d', strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ'), endpoint,
       status_code) AS line FROM requests WHERE is_error"""
# the newest production time among the pings that have arrived, per ping
CLOCK = """
clock AS (SELECT event_id, us // 1000 AS produced_ms,
                 max(us) OVER (ORDER BY arrival_key, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) // 1000 AS processed_ms
          FROM trips),
stats AS (SELECT lc.taxi_id, lc.event_id, processed_ms, produced_ms FROM lc JOIN clock USING (event_id) WHERE avg_reason = 'ok')"""
ORACLES["end_to_end_latency"] = _lc_query("").rstrip() + f""",
{CLOCK}
SELECT taxi_id, event_id, processed_ms - produced_ms AS latency_ms FROM stats"""
ORACLES["end_to_end_latency_carry_tree"] = ORACLES["end_to_end_latency"]
ORACLES["latency_metrics"] = _lc_query("").rstrip() + f""",
{CLOCK}
SELECT (processed_ms // 3600000) * 3600 AS interval_start_s,
       floor((sum(processed_ms - produced_ms) / count(*)) * 100 + 0.5) / 100 AS latency_ms,
       {r6('count(*) / 3600.0::DOUBLE')} AS throughput, count(*) AS messages FROM stats GROUP BY 1"""
ORACLES["location_speed_interval_join"] = _lc_query(f"""
SELECT p.taxi_id, p.event_id, s.event_id AS speed_event_id, p.ts_ms, s.speed_kmph,
       s.is_speeding AS speed_is_speeding, p.end_flag, {grid_id_sql(DEFAULT, 'p.latitude', 'p.longitude')} AS grid_id
FROM lc p JOIN lc s ON s.taxi_id = p.taxi_id AND s.ts_ms BETWEEN p.ts_ms - 1800000 AND p.ts_ms + 1800000
WHERE p.kind = 'forwarded' AND s.speed_reason = 'ok'""")


ORACLES["file_report"] = f"""{with_(TRIPS, FILE_LINES)}
SELECT replace(file_name, '.txt', '') AS vehicle, CASE WHEN count(line) > 0 THEN 'read' ELSE 'empty' END AS state,
       CAST(count(line) AS BIGINT) AS lines
FROM (SELECT file_name, line FROM file_lines UNION ALL SELECT file_name, NULL FROM file_list) f GROUP BY file_name"""


# ------------------------------------------------ connectors (round trips)
ORACLES["raw_csv_scan"] = _raw_query("SELECT taxi_id, date_time, longitude, latitude FROM raw_pings")
ORACLES["prepared_csv_scan"] = _raw_query(
    "SELECT taxi_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS date_time, longitude, latitude, "
    "CAST(end_flag AS INTEGER) AS end_flag FROM prepared", PREPARED)
ORACLES["metrics_json_scan"] = _req_query(
    f"SELECT operator_name, interval_start_s, {M_LAT} AS latency_ms, "
    f"{r6('messages / 3600.0::DOUBLE')} AS throughput, cache_hits, cache_misses, "
    f"{r6('CAST(cache_hits AS DOUBLE) / nullif(cache_hits + cache_misses, 0)')} AS cache_hit_ratio FROM _m")


# ------------------------------------------------------ the live path
PARSED = """
parsed AS (
  SELECT * FROM (
    SELECT event_id, arrival_key, f[1] AS taxi_id,
           epoch_ms(try_strptime(f[2], '%Y-%m-%d %H:%M:%S')) AS ts_ms,
           TRY_CAST(f[4] AS DOUBLE) AS latitude, TRY_CAST(f[3] AS DOUBLE) AS longitude,
           (trim(f[5]) = '1' OR lower(trim(f[5])) = 'true') AS end_flag,
           TRY_CAST(f[6] AS DOUBLE) AS produced_ts
    FROM (SELECT event_id, arrival_key, string_split(message, ',') AS f FROM messages
          WHERE NOT starts_with(message, 'taxi_id')) m
  ) p WHERE taxi_id IS NOT NULL AND ts_ms IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL
        AND end_flag IS NOT NULL AND produced_ts IS NOT NULL AND isfinite(latitude) AND isfinite(longitude))"""
_REPLAY = with_(TRIPS, MESSAGES, PARSED, lifecycle_ctes('parsed', DEFAULT))
ORACLES["vehicle_stream_replay"] = (
    f"{_REPLAY}\nSELECT taxi_id, event_id, kind, status, area_violations, halt_event, total_distance_km, total_time_s, "
    "avg_reason, average_speed_kmph, speed_reason, speed_kmph, speeding_count, stored_total FROM lc")
ORACLES["vehicle_state_stream_replay"] = (
    f"{_REPLAY},\n{STATE}\nSELECT taxi_id, status, total_distance_km, last_update_ms, average_speed_kmph, "
    "current_speed_kmph, speeding, speeding_speed_kmph, ten_km_crossed, area_violations, fleet_km FROM state")
ORACLES["event_log_stream_replay"] = f"{_REPLAY}\nSELECT taxi_id, event_id, arrival_key, sub, kind, message FROM lc_events"
ORACLES["status_count_series_stream_replay"] = f"{_REPLAY}\n{_SERIES}"
ORACLES["location_speed_join_stream_replay"] = (
    f"{with_(TRIPS, MESSAGES, PARSED, lifecycle_ctes('parsed', DEFAULT))}\n"
    "SELECT p.taxi_id, p.event_id, s.event_id AS speed_event_id, p.ts_ms, s.speed_kmph, "
    "s.is_speeding AS speed_is_speeding, p.end_flag "
    "FROM lc p JOIN lc s ON s.taxi_id = p.taxi_id AND s.ts_ms BETWEEN p.ts_ms - 1800000 AND p.ts_ms + 1800000 "
    "WHERE p.kind = 'forwarded' AND s.speed_reason = 'ok'")

# ------------------------------------------------------ idle vehicles expire
IDLE_MS, DELAY_MS = 1800000, 1800000


def sessions_ctes(src: str) -> str:
    """``sessions``: the rows of ``src`` with their session; taxi_id names both."""
    return f"""
_newest AS (SELECT *, max(ts_ms) OVER {W_EXC} AS newest FROM {src}),
_started AS (SELECT * EXCLUDE (newest), max(CASE WHEN newest IS NULL OR ts_ms - newest > {IDLE_MS} THEN ts_ms END) OVER {W_INC}
             AS session_start_ms FROM _newest),
sessions AS (SELECT * REPLACE (concat(taxi_id, '#', CAST(session_start_ms AS VARCHAR)) AS taxi_id) FROM _started)"""


_OF = "split_part(taxi_id, '#', 1) AS taxi_id, CAST(split_part(taxi_id, '#', 2) AS BIGINT) AS session_start_ms"
ORACLES["vehicle_sessions"] = (
    f"{with_(TRIPS, sessions_ctes('trips'))}\nSELECT {_OF}, max(ts_ms) AS newest_ms, CAST(count(*) AS BIGINT) AS pings, "
    f"max(ts_ms) + {IDLE_MS} AS expires_ms FROM sessions GROUP BY sessions.taxi_id")
ORACLES["trip_stats_with_expiry"] = (
    f"{with_(TRIPS, sessions_ctes('trips'), lifecycle_ctes('sessions', DEFAULT))}\nSELECT {_OF}, event_id, kind, status, "
    "area_violations, halt_event, total_distance_km, total_time_s, avg_reason, average_speed_kmph, stored_total FROM lc")
_ARRIVED = """
arrived AS (SELECT * REPLACE (event_id + CASE WHEN event_id % 17 = 0 THEN 5 ELSE 0 END AS arrival_key) FROM parsed)"""
ORACLES["vehicle_expiry_stream_replay"] = f"""{with_(TRIPS, MESSAGES, PARSED, _ARRIVED, sessions_ctes('arrived'), lifecycle_ctes('sessions', DEFAULT))},
ends AS (SELECT taxi_id, max(ts_ms) OVER s + {IDLE_MS} AS expires_ms, k = max(k) OVER s AS is_last, area_violations, s_tot_cents / 100.0::DOUBLE AS km,
                s_tot_s, speeding_count, stored_total FROM lc WINDOW s AS (PARTITION BY taxi_id)),
ended AS (SELECT *, lead(session_start_ms) OVER (PARTITION BY taxi_id ORDER BY session_start_ms) AS next_ms
          FROM (SELECT {_OF}, * EXCLUDE (taxi_id) FROM ends WHERE is_last) e)
SELECT {_OF}, event_id, ts_ms, kind, status, area_violations, total_distance_km, total_time_s, avg_reason, speed_reason,
       speed_kmph, speeding_count, stored_total FROM lc
UNION ALL
SELECT taxi_id, session_start_ms, NULL, expires_ms, 'expired', NULL, area_violations, km, s_tot_s, NULL, NULL, NULL,
       speeding_count, stored_total
FROM ended WHERE next_ms IS NOT NULL OR expires_ms < (SELECT max(ts_ms) - {DELAY_MS} FROM arrived)"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
