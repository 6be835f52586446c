"""DuckDB text of the geofence operators (``operators/trips.py``) with plain windows."""

from __future__ import annotations

from ..config import DEFAULT, FleetConfig

D2R = "0.017453292519943295::DOUBLE"


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str, cfg: FleetConfig = DEFAULT) -> str:
    hl = f"((({lat2}) - ({lat1})) * {D2R}) / 2"
    hn = f"((({lon2}) - ({lon1})) * {D2R}) / 2"
    a = (f"(sin({hl}) * sin({hl}) + cos(({lat1}) * {D2R}) * cos(({lat2}) * {D2R})"
         f" * sin({hn}) * sin({hn}))")
    return f"({cfg.earth_radius_km}::DOUBLE * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def center_sql(lat: str, lon: str, cfg: FleetConfig = DEFAULT) -> str:
    return hav_sql(f"{cfg.center_lat}::DOUBLE", f"{cfg.center_lon}::DOUBLE", lat, lon, cfg)


def r2(x: str) -> str:
    return f"(floor(({x}) * 100 + 0.5) / 100)"


def r6(x: str) -> str:
    return f"(floor(({x}) * 1000000 + 0.5) / 1000000)"


W_INC = "(PARTITION BY taxi_id ORDER BY arrival_key, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
W_EXC = "(PARTITION BY taxi_id ORDER BY arrival_key, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def steps_ctes(src: str = "trips", cfg: FleetConfig = DEFAULT) -> str:
    """CTEs ``_s1`` … ``steps`` over a ping relation ``src``."""
    return f"""
_s1 AS (SELECT *, max(ts_ms) OVER {W_EXC} AS prev_max_ts FROM {src}),
_s2 AS (SELECT *, (prev_max_ts IS NULL OR ts_ms >= prev_max_ts) AS accepted,
               {center_sql('latitude', 'longitude', cfg)} AS d_center_km FROM _s1),
_s3 AS (SELECT *, accepted AND d_center_km > {cfg.remove_radius_km} AS discarded,
               accepted AND d_center_km <= {cfg.remove_radius_km} AS forwarded,
               d_center_km > {cfg.warn_radius_km} AS far FROM _s2),
_s4 AS (SELECT *,
          sum(CAST(discarded AS INTEGER)) OVER {W_INC} AS area_violations,
          last_value(CASE WHEN forwarded THEN far END IGNORE NULLS) OVER {W_EXC} AS p_far
        FROM _s3),
steps AS (SELECT *,
          CASE WHEN forwarded AND far AND NOT coalesce(p_far, false) THEN 'warn'
               WHEN forwarded AND NOT far AND coalesce(p_far, false) THEN 'reset' END AS area_event
        FROM _s4)"""
