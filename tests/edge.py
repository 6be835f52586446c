"""Helpers for hand-written ping tables."""

from gpsweave.config import DEFAULT
from gpsweave.operators.lifecycle import DEG_TO_RAD

C = DEFAULT


def north(km: float, east_km: float = 0.0):
    """(lat, lon) ``km`` north and ``east_km`` east of the centre (small offsets)."""
    lat = C.center_lat + (km / C.earth_radius_km) / DEG_TO_RAD
    lon = C.center_lon + (east_km / (C.earth_radius_km * 0.7664)) / DEG_TO_RAD
    return lat, lon


def pings(spark, rows, taxi="7"):
    """rows: (t_seconds, (lat, lon), end_flag) in arrival order."""
    data = [(taxi, 1_700_000_000_000 + int(t * 1000), p[0], p[1], bool(end), 0.0, i, i)
            for i, (t, p, end) in enumerate(rows)]
    return spark.createDataFrame(
        data, "taxi_id string, ts_ms long, latitude double, longitude double, end_flag boolean, "
              "produced_ts double, arrival_key long, event_id long")
