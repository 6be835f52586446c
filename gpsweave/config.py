"""Thresholds and constants of the fleet pipeline, in one frozen object.

Every operator takes its numbers from a ``FleetConfig`` so that tests and
fixtures can override them (for example a larger grid cell) without touching
operator code.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class FleetConfig:
    # --- fixed values that must equal the reference for identical results ---
    # geofence centre (latitude, longitude) and earth radius in km
    center_lat: float = 39.9163
    center_lon: float = 116.3972
    earth_radius_km: float = 6371.0
    # geofence radii in km: warn beyond 10, discard beyond 15
    warn_radius_km: float = 10.0
    remove_radius_km: float = 15.0
    # speed gates
    speed_limit_kmph: float = 50.0
    max_speed_kmph: float = 300.0
    min_time_s: float = 2.0
    min_distance_km: float = 0.01
    # halt detection: cumulative still seconds
    halt_after_s: int = 180
    # traffic grid: cell size, area radius, km per degree of latitude / longitude
    cell_km: float = 0.5
    grid_radius_km: float = 15.0
    km_per_deg_lat: float = 111.32
    km_per_deg_lon: float = 85.23
    # traffic grid window and status thresholds
    grid_window: str = "10 seconds"
    # event-time watermark (bounded out-of-orderness)
    watermark: str = "2 minutes"
    # raw-file bounding box (inclusive)
    bbox_lon_min: float = 110.0
    bbox_lon_max: float = 125.0
    bbox_lat_min: float = 35.0
    bbox_lat_max: float = 45.0
    # operational metric interval in seconds
    metric_interval_s: int = 5
    # --- engine parameters (ours, not the reference's) ---
    # chunking of the per-vehicle scans (plans/scan.py): about this many of a
    # vehicle's own pings per chunk, for any vehicle and any data size
    scan_chunk_rows: int = 1 << 20
    # summary rows of one key that a window of the carry tree sees at most
    scan_fan_out: int = 1 << 12

    def with_(self, **kw) -> "FleetConfig":
        return replace(self, **kw)

    # derived grid constants
    @property
    def lat_delta(self) -> float:
        return self.cell_km / self.km_per_deg_lat

    @property
    def lon_delta(self) -> float:
        return self.cell_km / self.km_per_deg_lon

    @property
    def grid_min_lat(self) -> float:
        return self.center_lat - (self.grid_radius_km / self.km_per_deg_lat)

    @property
    def grid_min_lon(self) -> float:
        return self.center_lon - (self.grid_radius_km / self.km_per_deg_lon)


DEFAULT = FleetConfig()

# Parameters the fixtures use so that the grid check sees several vehicles per
# cell (the live 0.5 km / 10 s setting would leave most cells with one vehicle).
FIXTURE_GRID = DEFAULT.with_(cell_km=5.0, grid_window="1 day")
