"""The fleet's current positions clustered by a Z-order key.

``write_geo_index`` sorts the state by the interleaved bits of latitude and
longitude into runs of about equal size, one folder each, and writes a manifest
with every run's key range. A rectangle becomes a few key ranges; only runs that
meet one of them are read (partition pruning), and the exact positions decide.
Radius and nearest-k lookups use the rectangles around a circle.

Positions outside the world's rectangle are clipped to its border cells, so they
are found by their exact position like any other; rows without a position are
in no run. Many vehicles at one place are spread over runs by their id.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from ..config import DEFAULT, FleetConfig
from ..functions.geo import haversine_expr, round6

BITS = 20                    # per axis: a cell is about 20 m high
CELLS = 1 << BITS
MAX_RANGES = 64              # key ranges of a rectangle
KM_PER_DEGREE = math.pi / 180.0


def _cell(x: Column, low: float, width: float) -> Column:
    cell = F.floor((x - F.lit(low)) / F.lit(width) * F.lit(float(CELLS)))
    return F.least(F.greatest(cell, F.lit(0)), F.lit(CELLS - 1)).cast("long")


def _cell_of(x: float, low: float, width: float) -> int:
    return min(max(math.floor((x - low) / width * float(CELLS)), 0), CELLS - 1)


def _spread(x: Column) -> Column:
    """The bits of ``x`` with a zero before each: halves are moved apart,
    then quarters, down to single bits."""
    gap = 16
    while gap:
        keep = sum(((1 << gap) - 1) << at for at in range(0, 64, 2 * gap)) & (1 << 63) - 1
        x = x.bitwiseOR(F.shiftleft(x, gap)).bitwiseAND(F.lit(keep))
        gap //= 2
    return x


def z_key(lat: str = "latitude", lon: str = "longitude") -> Column:
    """The Z-order key: latitude bits before longitude bits; null without a position."""
    row, column = _cell(F.col(lat), -90.0, 180.0), _cell(F.col(lon), -180.0, 360.0)
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column))


def z_ranges(lat_min: float, lon_min: float, lat_max: float, lon_max: float,
             most: int = MAX_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` inclusive key ranges that cover the rectangle: squares
    are quartered, level by level, while a square crosses the rectangle's
    border and the ranges suffice; neighbouring ranges are joined."""
    if lat_min > lat_max or lon_min > lon_max:
        return []
    r0, r1 = _cell_of(lat_min, -90.0, 180.0), _cell_of(lat_max, -90.0, 180.0)
    c0, c1 = _cell_of(lon_min, -180.0, 360.0), _cell_of(lon_max, -180.0, 360.0)
    done: list[tuple[int, int]] = []
    open_, side = [(0, 0, 0)], CELLS             # (first key, row, column) of squares
    while open_ and side > 1 and len(done) + 4 * len(open_) <= most:
        side //= 2
        parts = [(z + (2 * i + j) * side * side, row + i * side, col + j * side)
                 for z, row, col in open_ for i in (0, 1) for j in (0, 1)]
        open_ = []
        for z, row, col in parts:
            if row > r1 or row + side <= r0 or col > c1 or col + side <= c0:
                continue
            if r0 <= row and row + side - 1 <= r1 and c0 <= col and col + side - 1 <= c1:
                done.append((z, z + side * side - 1))
            else:
                open_.append((z, row, col))
    out: list[tuple[int, int]] = []
    for a, b in sorted(done + [(z, z + side * side - 1) for z, _, _ in open_]):
        if out and out[-1][1] + 1 == a:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def circle_boxes(lat: float, lon: float, km: float, cfg: FleetConfig = DEFAULT) -> list[tuple[float, float, float, float]]:
    """Rectangles (lat_min, lon_min, lat_max, lon_max) that hold every point
    within ``km``: two where the circle crosses the date line, the whole range
    of longitudes where it holds a pole."""
    degrees = km / cfg.earth_radius_km / KM_PER_DEGREE * (1 + 1e-9) + 1e-9
    south, north = lat - degrees, lat + degrees
    if south <= -90.0 or north >= 90.0:
        return [(max(south, -90.0), -180.0, min(north, 90.0), 180.0)]
    # the meridian that touches the circle
    half = math.degrees(math.asin(min(1.0, math.sin(math.radians(degrees)) / math.cos(math.radians(lat))))) + 1e-9
    west, east = lon - half, lon + half
    if half >= 180.0:
        return [(south, -180.0, north, 180.0)]
    if west < -180.0:
        return [(south, -180.0, north, east), (south, west + 360.0, north, 180.0)]
    if east > 180.0:
        return [(south, west, north, 180.0), (south, -180.0, north, east - 360.0)]
    return [(south, west, north, east)]


def write_geo_index(state: DataFrame, path: str, run_rows: int = 1 << 20, id_col: str = "taxi_id") -> None:
    """Write the rows that have a position to ``path``: ``runs`` in key order,
    a partition folder of about ``run_rows`` rows each, and their ``manifest``.
    ``state`` should be a written table: it is read to count, to sample the
    borders and to write. One range shuffle."""
    rows = state.filter("latitude IS NOT NULL AND longitude IS NOT NULL").withColumn("z", z_key())
    n_runs = max(1, -(-rows.count() // run_rows))
    (rows.repartitionByRange(n_runs, "z", id_col).withColumn("run", F.spark_partition_id())
     .sortWithinPartitions("run", "z", id_col).write.partitionBy("run").parquet(f"{path}/runs"))
    runs = state.sparkSession.read.schema("z long, run int").parquet(f"{path}/runs")
    (runs.groupBy("run").agg(F.min("z").alias("first"), F.max("z").alias("last"), F.count(F.lit(1)).alias("n"))
     .coalesce(1).write.parquet(f"{path}/manifest"))


class GeoIndex:
    """Lookups in an index that ``write_geo_index`` wrote. ``schema`` is that
    of the state. The manifest (a row per run) stays a table; only the numbers
    of the runs that meet a lookup's ranges come to the driver."""

    def __init__(self, spark: SparkSession, path: str, schema):
        fields = StructType([*schema.fields, StructField("z", LongType()), StructField("run", IntegerType())])
        self.rows = spark.read.schema(fields).parquet(f"{path}/runs")
        self.manifest = spark.read.schema("run int, first long, last long, n long").parquet(f"{path}/manifest")
        self.columns = [f.name for f in schema.fields]

    def runs(self, boxes) -> list[tuple[int, int]]:
        """(run, rows) of the runs that meet the boxes' key ranges."""
        ranges = [r for box in boxes for r in z_ranges(*box)]
        if not ranges:
            return []
        meets = " OR ".join(f"(first <= {b} AND last >= {a})" for a, b in ranges)
        return [(r["run"], r["n"]) for r in self.manifest.filter(meets).select("run", "n").collect()]

    def _read(self, boxes, runs) -> DataFrame:
        keys = " OR ".join(f"(z BETWEEN {a} AND {b})" for box in boxes for a, b in z_ranges(*box)) or "false"
        exact = " OR ".join(f"(latitude BETWEEN {s!r}D AND {n!r}D AND longitude BETWEEN {w!r}D AND {e!r}D)"
                            for s, w, n, e in boxes) or "false"
        return self.rows.filter(F.col("run").isin([r for r, _ in runs])).filter(keys).filter(exact).select(*self.columns)

    def in_bounds(self, lat_min: float, lon_min: float, lat_max: float, lon_max: float) -> DataFrame:
        """V9: the rows inside the rectangle, borders included."""
        boxes = [(float(lat_min), float(lon_min), float(lat_max), float(lon_max))]
        return self._read(boxes, self.runs(boxes))

    def _within(self, boxes, runs, lat, lon, km, cfg) -> DataFrame:
        d = round6(haversine_expr(f"{float(lat)!r}D", f"{float(lon)!r}D", "latitude", "longitude", cfg))
        return self._read(boxes, runs).withColumn("distance_km", d).filter(F.col("distance_km") <= F.lit(float(km)))

    def near(self, lat: float, lon: float, km: float, cfg: FleetConfig = DEFAULT) -> DataFrame:
        """The rows at most ``km`` away (to a millionth), with ``distance_km``."""
        boxes = circle_boxes(lat, lon, km + 1e-6, cfg)
        return self._within(boxes, self.runs(boxes), lat, lon, km, cfg)

    def nearest(self, lat: float, lon: float, k: int, id_col: str = "taxi_id", first_km: float = 1.0,
                cfg: FleetConfig = DEFAULT) -> DataFrame:
        """The ``k`` rows nearest to a point, ties by id; all of them if there
        are fewer. The circle doubles until it holds ``k`` rows; a circle whose
        runs hold fewer, by the manifest, isn't read."""
        km, half_way = first_km, math.pi * cfg.earth_radius_km
        while True:
            boxes = circle_boxes(lat, lon, km + 1e-6, cfg)
            runs = self.runs(boxes)
            found = self._within(boxes, runs, lat, lon, km, cfg)
            if km > half_way or (sum(n for _, n in runs) >= k and found.limit(k).count() >= k):
                return found.orderBy("distance_km", id_col).limit(k)
            km *= 2
