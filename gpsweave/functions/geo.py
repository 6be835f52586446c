"""Geographic and rounding column expressions.

All of these are native Catalyst expressions, so they stay inside whole-stage
codegen. The same formulas are spelled as SQL text in ``oracles`` for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig

DEG_TO_RAD = 0.017453292519943295  # pi / 180 as a double


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, cfg: FleetConfig = DEFAULT) -> str:
    """Great-circle distance in km between two points given in degrees, as Spark
    SQL text over column expressions given as text (``F.expr`` builds it in one
    call instead of one driver round trip per operator)."""
    d2r = f"{DEG_TO_RAD!r}D"
    hl = f"((({lat2}) - ({lat1})) * {d2r}) / 2"
    hn = f"((({lon2}) - ({lon1})) * {d2r}) / 2"
    a = (f"(sin({hl}) * sin({hl}) + cos(({lat1}) * {d2r}) * cos(({lat2}) * {d2r})"
         f" * sin({hn}) * sin({hn}))")
    return f"({cfg.earth_radius_km!r}D * (2 * atan2(sqrt({a}), sqrt(1 - {a}))))"


def haversine_expr(lat1: str, lon1: str, lat2: str, lon2: str, cfg: FleetConfig = DEFAULT) -> Column:
    return F.expr(haversine_sql(lat1, lon1, lat2, lon2, cfg))


def distance_from_center_km(lat="latitude", lon="longitude", cfg: FleetConfig = DEFAULT) -> Column:
    """T4 over two column names."""
    return haversine_expr(f"{cfg.center_lat!r}D", f"{cfg.center_lon!r}D", lat, lon, cfg)


def round_half_up(x, digits: int = 2) -> Column:
    """``Math.round(x * 10^d) / 10^d``: floor(x*10^d + 0.5) / 10^d.

    ``F.round`` rounds the decimal expansion and differs on values such as
    2.675, so it is not used where the reference rounds doubles.
    """
    s = float(10 ** digits)
    return F.floor(_c(x) * s + 0.5) / s


def round6(x) -> Column:
    """Rounding used on every floating output so engines agree bit for bit."""
    return round_half_up(x, 6)


def grid_index(lat, lon, cfg: FleetConfig = DEFAULT) -> tuple[Column, Column]:
    """Cell row and column; the cast truncates toward zero like Java ``(int)``."""
    lat_i = ((_c(lat) - cfg.grid_min_lat) / cfg.lat_delta).cast("int")
    lon_i = ((_c(lon) - cfg.grid_min_lon) / cfg.lon_delta).cast("int")
    return lat_i, lon_i


def grid_id(lat, lon, cfg: FleetConfig = DEFAULT) -> Column:
    lat_i, lon_i = grid_index(lat, lon, cfg)
    return F.concat_ws("_", lat_i.cast("string"), lon_i.cast("string"))


def grid_bounds(gid, cfg: FleetConfig = DEFAULT) -> dict[str, Column]:
    """Bottom-left and top-right corners of a cell id ``<lat>_<lon>``."""
    parts = F.split(_c(gid), "_")
    lat_i = F.get(parts, 0).cast("int")
    lon_i = F.get(parts, 1).cast("int")
    bl_lat = F.lit(cfg.grid_min_lat) + lat_i * F.lit(cfg.lat_delta)
    bl_lon = F.lit(cfg.grid_min_lon) + lon_i * F.lit(cfg.lon_delta)
    return {
        "bottom_left_lat": bl_lat,
        "bottom_left_lon": bl_lon,
        "top_right_lat": bl_lat + F.lit(cfg.lat_delta),
        "top_right_lon": bl_lon + F.lit(cfg.lon_delta),
    }
