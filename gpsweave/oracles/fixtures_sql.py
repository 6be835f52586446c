"""DuckDB text of the fixtures in ``sources/fixtures.py`` (as CTEs).

The oracle queries run on DuckDB over the driver's views; each one starts with
the CTEs it needs from here.
"""

from __future__ import annotations

FMT = "strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S')"

TRIPS = """
_e AS (
  SELECT event_id, user_id, value, epoch_us(ts) AS us,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS rn,
         ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rrn
  FROM events),
_p AS (SELECT *, rn // 3 AS slot, CAST((us - 1704067200000000) // 40000000 AS BIGINT) AS s FROM _e),
_g AS (SELECT *, 39916300 + ((user_id*7919 + slot*104729) % 2001 - 1000) * 125 AS lat_e6,
              116397200 + ((user_id*6007 + slot*15485863) % 2003 - 1001) * 160 AS lon_e6 FROM _p),
trips AS (
  SELECT CAST(user_id AS VARCHAR) AS taxi_id,
         (1704067200 + s) * 1000 AS ts_ms,
         CAST(lat_e6 AS DOUBLE) / 1000000 AS latitude,
         CAST(lon_e6 AS DOUBLE) / 1000000 AS longitude,
         rrn = 1 AS end_flag,
         CAST(us AS DOUBLE) / 1000000 AS produced_ts,
         event_id + CASE WHEN event_id % 17 = 0 THEN 300 ELSE 0 END AS arrival_key,
         event_id, lat_e6, lon_e6, value, us
  FROM _g)"""

MESSAGES = f"""
messages AS (
  SELECT event_id, arrival_key, CASE
    WHEN event_id % 97 = 0 THEN 'taxi_id,date_time,longitude,latitude,end_flag'
    WHEN event_id % 89 = 0 THEN concat(taxi_id, ',bad-date,116.4,39.9,0,1.0')
    WHEN event_id % 83 = 0 THEN concat(taxi_id, ',2024-01-01 00:00:00,116.4')
    WHEN event_id % 79 = 0 THEN concat(taxi_id, ',2024-01-01 00:00:00,abc,39.9,0,1.0')
    ELSE concat(taxi_id, ',', {FMT}, ',',
      CAST(lon_e6 // 1000000 AS VARCHAR), '.', lpad(CAST(lon_e6 % 1000000 AS VARCHAR), 6, '0'), ',',
      CAST(lat_e6 // 1000000 AS VARCHAR), '.', lpad(CAST(lat_e6 % 1000000 AS VARCHAR), 6, '0'), ',',
      CASE WHEN end_flag THEN ' True ' ELSE '0' END, ',', CAST(ts_ms // 1000 AS VARCHAR)) END AS message
  FROM trips)"""

RAW_PINGS = f"""
raw_pings AS (
  SELECT event_id, arrival_key, taxi_id,
         CASE WHEN event_id % 89 = 0 THEN 'not a date' ELSE {FMT} END AS date_time,
         CASE WHEN event_id % 71 = 0 THEN CAST(100 AS DOUBLE)
              WHEN event_id % 67 = 0 THEN CAST(125 AS DOUBLE)
              WHEN event_id % 61 = 0 THEN NULL ELSE longitude END AS longitude,
         CASE WHEN event_id % 59 = 0 THEN CAST(45.5 AS DOUBLE) ELSE latitude END AS latitude
  FROM trips)"""

FILE_LINES = f"""
file_lines AS (
  SELECT concat('veh_', taxi_id, '.txt') AS file_name,
         CASE WHEN event_id % 53 = 0 THEN '  ' ELSE concat(taxi_id, ',', {FMT}) END AS line
  FROM trips),
file_list AS (SELECT concat('veh_', CAST(c_custkey AS VARCHAR), '.txt') AS file_name FROM customer)"""

GRID_SPEEDS = """
grid_speeds AS (
  SELECT t.taxi_id, t.event_id, t.ts_ms, t.latitude, t.longitude, t.value / 10 AS speed_kmph,
         e.ts AS ts
  FROM trips t JOIN events e ON e.event_id = t.event_id)"""

REQUESTS = """
requests AS (
  SELECT event_id, ts, epoch_us(ts) AS ts_us, event_type AS endpoint, value / 1000 AS latency_s,
         CASE WHEN event_id % 13 = 0 THEN 500 WHEN event_id % 7 = 0 THEN 404 ELSE 200 END AS status_code,
         event_id % 13 = 0 AS is_error, event_id % 3 <> 0 AS cache_hit
  FROM events)"""


def with_(*ctes: str) -> str:
    """``WITH`` clause joining CTE texts (the ``trips`` CTE first when used)."""
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes)
