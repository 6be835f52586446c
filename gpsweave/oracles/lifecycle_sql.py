"""DuckDB recursive CTE of the per-vehicle state machine (``operators/lifecycle.py``).

Row k+1 of every vehicle is joined to the state after row k; each nesting
level below computes one stage of the step. The relation ``lc`` has one row
per ping with the same output columns as the Spark machine, plus the state
after the row (``s_*``) and the event texts (``ev_*``).
"""

from __future__ import annotations

from ..config import DEFAULT, FleetConfig
from .trips_sql import center_sql, hav_sql, r2


def lifecycle_ctes(src: str = "trips", cfg: FleetConfig = DEFAULT) -> str:
    c = cfg
    hav_step = hav_sql("s_last_lat", "s_last_lon", "latitude", "longitude", c)
    hav_anchor = hav_sql("s_anchor_lat", "s_anchor_lon", "latitude", "longitude", c)
    return f"""
_lp AS (SELECT taxi_id, event_id, arrival_key, ts_ms, latitude, longitude, end_flag, produced_ts,
               {center_sql('latitude', 'longitude', c)} AS d,
               ROW_NUMBER() OVER (PARTITION BY taxi_id ORDER BY arrival_key, event_id) AS k
        FROM {src}),
_lr AS (
  SELECT taxi_id, CAST(0 AS BIGINT) AS k,
    CAST(NULL AS BIGINT) AS s_max_ts, CAST(0 AS BIGINT) AS s_area_count, false AS s_warned,
    false AS s_has_last, 0.0::DOUBLE AS s_last_lat, 0.0::DOUBLE AS s_last_lon, CAST(0 AS BIGINT) AS s_last_ts,
    CAST(0 AS BIGINT) AS s_tot_cents, CAST(0 AS BIGINT) AS s_tot_s, CAST(0 AS BIGINT) AS s_halt_s,
    false AS s_halted, CAST(NULL AS VARCHAR) AS s_status, CAST(0 AS BIGINT) AS s_stored,
    false AS s_has_anchor, 0.0::DOUBLE AS s_anchor_lat, 0.0::DOUBLE AS s_anchor_lon,
    CAST(0 AS BIGINT) AS s_anchor_ts, CAST(0 AS BIGINT) AS s_speeding,
    CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS BIGINT) AS arrival_key, CAST(NULL AS BIGINT) AS ts_ms,
    CAST(NULL AS DOUBLE) AS latitude, CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS BOOLEAN) AS end_flag,
    CAST(NULL AS DOUBLE) AS produced_ts, CAST(NULL AS DOUBLE) AS d_center_km,
    CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS area_event,
    CAST(NULL AS DOUBLE) AS step_km, CAST(NULL AS BIGINT) AS step_s, CAST(NULL AS VARCHAR) AS halt_event,
    CAST(NULL AS DOUBLE) AS total_distance_km, CAST(NULL AS BIGINT) AS total_time_s,
    CAST(NULL AS VARCHAR) AS trip_reset, CAST(NULL AS VARCHAR) AS avg_reason,
    CAST(NULL AS DOUBLE) AS average_speed_kmph, CAST(NULL AS VARCHAR) AS speed_reason,
    CAST(NULL AS DOUBLE) AS speed_kmph, CAST(NULL AS BOOLEAN) AS is_speeding,
    CAST(NULL AS VARCHAR) AS status_before, CAST(NULL AS BIGINT) AS fleet_delta_cents,
    CAST(NULL AS VARCHAR) AS ev_removal, CAST(NULL AS VARCHAR) AS ev_warn, CAST(NULL AS VARCHAR) AS ev_halt,
    CAST(NULL AS VARCHAR) AS ev_status, CAST(NULL AS VARCHAR) AS ev_speeding
  FROM (SELECT DISTINCT taxi_id FROM _lp) v
  UNION ALL
  SELECT taxi_id, k,
    CASE WHEN late THEN s_max_ts ELSE ts_ms END,
    s_area_count + CAST(disc AS BIGINT),
    CASE WHEN fwd THEN d > {c.warn_radius_km} ELSE s_warned END,
    CASE WHEN fwd THEN NOT x_reset ELSE s_has_last END,
    CASE WHEN fwd AND NOT x_reset THEN latitude ELSE s_last_lat END,
    CASE WHEN fwd AND NOT x_reset THEN longitude ELSE s_last_lon END,
    CASE WHEN fwd AND NOT x_reset THEN ts_ms ELSE s_last_ts END,
    CASE WHEN fwd THEN (CASE WHEN x_reset THEN 0 ELSE x_tot_cents END) ELSE s_tot_cents END,
    CASE WHEN fwd THEN (CASE WHEN x_reset THEN 0 ELSE x_tot_s END) ELSE s_tot_s END,
    CASE WHEN fwd THEN x_halt_s ELSE s_halt_s END,
    CASE WHEN x_halt_on THEN true WHEN x_halt_off THEN false ELSE s_halted END,
    NULLIF(CASE WHEN fwd THEN st3 ELSE st1 END, ''),
    CASE WHEN disc THEN 0 WHEN NOT fwd THEN s_stored WHEN x_avg_reason = 'ok' THEN x_tot_cents
         WHEN x_step_km > 0 THEN x_tot_cents ELSE s_stored END,
    CASE WHEN x_anchor_moves THEN NOT end_flag ELSE s_has_anchor END,
    CASE WHEN x_anchor_moves AND NOT end_flag THEN latitude ELSE s_anchor_lat END,
    CASE WHEN x_anchor_moves AND NOT end_flag THEN longitude ELSE s_anchor_lon END,
    CASE WHEN x_anchor_moves AND NOT end_flag THEN ts_ms ELSE s_anchor_ts END,
    CASE WHEN x_anchor_moves AND end_flag THEN 0 ELSE s_speeding + CAST(x_speeding AS BIGINT) END,
    event_id, arrival_key, ts_ms, latitude, longitude, end_flag, produced_ts, d,
    CASE WHEN late THEN 'late' WHEN disc THEN 'discarded' ELSE 'forwarded' END,
    CASE WHEN fwd AND d > {c.warn_radius_km} AND NOT s_warned THEN 'warn'
         WHEN fwd AND d <= {c.warn_radius_km} AND s_warned THEN 'reset' END,
    x_step_km, x_step_s,
    CASE WHEN x_halt_on THEN 'halt' WHEN x_halt_off THEN 'resume' END,
    CASE WHEN fwd THEN x_total_km END, CASE WHEN fwd THEN x_tot_s END,
    CASE WHEN fwd AND end_flag THEN 'end_flag' WHEN x_reset THEN 'removal' END,
    x_avg_reason, CASE WHEN x_avg_reason = 'ok' THEN x_avg END,
    x_speed_reason, CASE WHEN x_speed_reason = 'ok' THEN x_spd END,
    CASE WHEN x_speed_reason = 'ok' THEN x_spd > {c.speed_limit_kmph} END,
    s_status,
    CASE WHEN x_delta > 0 THEN x_delta ELSE 0 END,
    CASE WHEN disc AND st0 <> 'removed' THEN concat('[Removal Alert] Taxi Id:', taxi_id,
         ' removed after exceeding 15km zone. Area violations: ', CAST(s_area_count + 1 AS VARCHAR), '.') END,
    CASE WHEN fwd AND d > {c.warn_radius_km} AND NOT s_warned THEN
         concat('[Warning: Area Violation] Taxi Id:', taxi_id, ' exceeded 10km zone.') END,
    CASE WHEN x_halt_on AND st1 NOT IN ('removed', 'halted') THEN
              concat('[Warning] Taxi ID:', taxi_id, ' has been halted for more than 3 minutes.')
         WHEN x_halt_off AND st1 NOT IN ('removed', 'active') THEN
              concat('Taxi ID:', taxi_id, ' resumed movement and is marked as active.') END,
    CASE WHEN x_avg_reason = 'ok' AND end_flag AND st2 = '' THEN concat('[Status Update] ', taxi_id, 'is now INACTIVE.')
         WHEN x_avg_reason = 'ok' AND NOT end_flag AND st2 NOT IN ('halted', 'active') THEN
              concat('[Status Update] Taxi Id:', taxi_id, ' is now ACTIVE',
                     CASE st2 WHEN 'inactive' THEN ' (previously inactive)'
                              WHEN 'removed' THEN ' (after being removed due to area violation)' ELSE '' END, '.') END,
    CASE WHEN x_speeding THEN concat('[Speeding Alert] Taxi Id:', taxi_id, ' is speeding. Violation count: ',
         CAST(s_speeding + 1 AS VARCHAR), '.') END
  FROM (SELECT *,
          CASE WHEN x_avg_reason = 'ok' THEN
               CASE WHEN end_flag THEN 'inactive' WHEN st2 IN ('halted', 'active') THEN st2 ELSE 'active' END
               ELSE st2 END AS st3,
          coalesce(x_speed_reason = 'ok' AND x_spd > {c.speed_limit_kmph}, false) AS x_speeding,
          coalesce(x_speed_reason IN ('first', 'ok'), false) AS x_anchor_moves
  FROM (SELECT *,
          CASE WHEN NOT fwd THEN NULL
               WHEN x_tot_s < {c.min_time_s} OR x_total_km < {c.min_distance_km} THEN 'average_skipped'
               WHEN x_avg > {c.max_speed_kmph} THEN 'average_unrealistic' ELSE 'ok' END AS x_avg_reason,
          CASE WHEN NOT fwd THEN NULL WHEN NOT s_has_anchor THEN 'first'
               WHEN x_adt < {c.min_time_s} OR x_akm < {c.min_distance_km} THEN 'speed_skipped'
               WHEN x_spd >= {c.max_speed_kmph} THEN 'speed_unrealistic' ELSE 'ok' END AS x_speed_reason,
          fwd AND (end_flag OR st2 = 'removed') AS x_reset
  FROM (SELECT *,
          CASE WHEN x_halt_on AND st1 NOT IN ('removed', 'halted') THEN 'halted'
               WHEN x_halt_off AND st1 NOT IN ('removed', 'active') THEN 'active' ELSE st1 END AS st2,
          CASE WHEN x_step_km > 0 THEN x_tot_cents - s_stored END AS x_delta,
          {r2('x_total_km / (CAST(x_tot_s AS DOUBLE) / 3600.0::DOUBLE)')} AS x_avg,
          CASE WHEN x_akm IS NOT NULL AND NOT (x_adt < {c.min_time_s} OR x_akm < {c.min_distance_km})
               THEN floor((x_akm / x_adt) * 3600 * 100.0::DOUBLE + 0.5) / 100.0::DOUBLE END AS x_spd
  FROM (SELECT *,
          coalesce(x_step_km < {c.min_distance_km} AND NOT s_halted AND x_halt_s >= {c.halt_after_s}, false) AS x_halt_on,
          coalesce(x_step_km >= {c.min_distance_km} AND s_halted, false) AS x_halt_off,
          x_tot_cents / 100.0::DOUBLE AS x_total_km
  FROM (SELECT *,
          s_tot_cents + x_cents AS x_tot_cents, s_tot_s + coalesce(x_step_s, 0) AS x_tot_s,
          s_halt_s + CASE WHEN x_step_km < {c.min_distance_km} THEN x_step_s ELSE 0 END AS x_halt_s
  FROM (SELECT *,
          CASE WHEN x_step_km IS NOT NULL THEN
               CASE WHEN ts_ms - s_last_ts > 0 THEN (ts_ms - s_last_ts) // 1000 ELSE 0 END END AS x_step_s,
          CASE WHEN disc THEN 'removed' ELSE st0 END AS st1,
          CASE WHEN x_step_km > 0 THEN CAST(floor(x_step_km * 100 + 0.5) AS BIGINT) ELSE 0 END AS x_cents
  FROM (SELECT *,
          CASE WHEN fwd AND s_has_last THEN {hav_step} END AS x_step_km,
          CASE WHEN fwd AND s_has_anchor THEN {hav_anchor} END AS x_akm,
          CAST(ts_ms - s_anchor_ts AS DOUBLE) / 1000.0::DOUBLE AS x_adt,
          coalesce(s_status, '') AS st0
  FROM (SELECT *, NOT late AND d > {c.remove_radius_km} AS disc, NOT late AND d <= {c.remove_radius_km} AS fwd
  FROM (SELECT r.taxi_id, r.k + 1 AS k,
               r.s_max_ts, r.s_area_count, r.s_warned, r.s_has_last, r.s_last_lat, r.s_last_lon, r.s_last_ts,
               r.s_tot_cents, r.s_tot_s, r.s_halt_s, r.s_halted, r.s_status, r.s_stored, r.s_has_anchor,
               r.s_anchor_lat, r.s_anchor_lon, r.s_anchor_ts, r.s_speeding,
               p.event_id, p.arrival_key, p.ts_ms, p.latitude, p.longitude, p.end_flag, p.produced_ts, p.d,
               (r.s_max_ts IS NOT NULL AND p.ts_ms < r.s_max_ts) AS late
        FROM _lr r JOIN _lp p ON p.taxi_id = r.taxi_id AND p.k = r.k + 1
  ) a1) a2) a3) a4) a5) a6) a7) a8) a9
),
lc AS (SELECT *, s_area_count AS area_violations, s_warned AS warned, s_halted AS halted, s_status AS status,
              s_stored / 100.0::DOUBLE AS stored_total, s_speeding AS speeding_count
       FROM _lr WHERE k > 0),
lc_events AS (SELECT taxi_id, event_id, arrival_key,
                CAST(ROW_NUMBER() OVER (PARTITION BY taxi_id, event_id ORDER BY pos) - 1 AS INTEGER) AS sub,
                kind, message
                FROM (SELECT * FROM (
                  SELECT taxi_id, event_id, arrival_key, 0 AS pos, 'removal' AS kind, ev_removal AS message FROM lc
                  UNION ALL SELECT taxi_id, event_id, arrival_key, 1, 'area_warning', ev_warn FROM lc
                  UNION ALL SELECT taxi_id, event_id, arrival_key, 2,
                                   CASE WHEN halt_event = 'halt' THEN 'halt' ELSE 'resume' END, ev_halt FROM lc
                  UNION ALL SELECT taxi_id, event_id, arrival_key, 3,
                                   CASE WHEN end_flag THEN 'inactive' ELSE 'active' END, ev_status FROM lc
                  UNION ALL SELECT taxi_id, event_id, arrival_key, 4, 'speeding', ev_speeding FROM lc) e1
                  WHERE message IS NOT NULL) e2)"""
