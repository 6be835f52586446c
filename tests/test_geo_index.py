"""The geo index against brute force, and what a lookup reads."""

import math
import random
import re
import tempfile

import pytest

from gpsweave.operators.geo_index import BITS, GeoIndex, circle_boxes, write_geo_index, z_key, z_ranges
from gpsweave.operators.lifecycle import haversine

SCHEMA = "taxi_id string, latitude double, longitude double, status string"


def _rows(n, seed=5):
    rng = random.Random(seed)
    rows = [(str(i), rng.uniform(39.7, 40.1), rng.uniform(116.1, 116.7), "active") for i in range(n)]
    rows += [(f"far{i}", rng.uniform(-90, 90), rng.uniform(-180, 180), "halted") for i in range(n // 4)]
    rows += [(f"depot{i:04d}", 39.9163, 116.3972, None) for i in range(n // 2)]       # one place, many vehicles
    rows += [("dateline", 10.0, 179.999, "active"), ("across", 10.0, -179.999, "active"), ("north", 89.99, 50.0, "active"),
             ("pole", 90.0, 180.0, "active"), ("south", -90.0, -180.0, "active"), ("nowhere", None, None, "active"),
             ("half", 39.9, None, "active")]
    return rows


@pytest.fixture(scope="module")
def indexed(spark):
    rows = _rows(2000)
    path = tempfile.mkdtemp(prefix="gw-geo-") + "/index"
    state = spark.createDataFrame(rows, SCHEMA)
    write_geo_index(state, path, run_rows=100)
    return rows, GeoIndex(spark, path, state.schema), path


def _ids(df):
    return sorted(r["taxi_id"] for r in df.collect())


@pytest.mark.parametrize("box", [(39.85, 116.30, 39.98, 116.50), (39.9163, 116.3972, 39.9163, 116.3972),
                                 (-90.0, -180.0, 90.0, 180.0), (89.0, -180.0, 90.0, 180.0), (40.0, 116.0, 39.0, 117.0)])
def test_rectangles(indexed, box):
    rows, index, _ = indexed
    want = sorted(i for i, lat, lon, _ in rows if lat is not None and lon is not None
                  and box[0] <= lat <= box[2] and box[1] <= lon <= box[3])
    assert _ids(index.in_bounds(*box)) == want


@pytest.mark.parametrize("lat,lon,km", [(39.9163, 116.3972, 5.0), (10.0, 180.0, 1.0), (10.0, -179.9995, 300.0),
                                        (89.9, 0.0, 50.0), (-89.0, 10.0, 500.0), (60.0, 20.0, 3000.0), (0.0, 0.0, 30000.0)])
def test_circles(indexed, lat, lon, km):
    rows, index, _ = indexed
    want = sorted(i for i, a, b, _ in rows if a is not None and b is not None and haversine(lat, lon, a, b, 6371.0) <= km)
    assert _ids(index.near(lat, lon, km)) == want


@pytest.mark.parametrize("lat,lon,k", [(39.9163, 116.3972, 7), (10.0, 180.0, 3), (-45.0, -120.0, 5), (0.0, 0.0, 100000)])
def test_nearest(indexed, lat, lon, k):
    rows, index, _ = indexed
    by = sorted((math.floor(haversine(lat, lon, a, b, 6371.0) * 1e6 + 0.5) / 1e6, i) for i, a, b, _ in rows
                if a is not None and b is not None)
    assert [(r["distance_km"], r["taxi_id"]) for r in index.nearest(lat, lon, k).collect()] == by[:k]


def test_a_lookup_reads_only_covering_runs(spark, indexed):
    rows, index, path = indexed
    manifest = index.manifest.collect()
    assert len(manifest) >= 30 and sum(r["n"] for r in manifest) == len(rows) - 2
    assert max(r["n"] for r in manifest) <= 300          # the depot is spread by id
    box = (39.80, 116.20, 39.82, 116.22)
    ranges = z_ranges(*box)
    meet = {r["run"] for r in manifest if any(r["first"] <= b and r["last"] >= a for a, b in ranges)}
    found = index.in_bounds(*box)
    assert {r for r, _ in index.runs([box])} == meet and len(meet) <= 5
    scan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[.*run", scan)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    read = plan.metrics().get("numFiles").get().value()
    assert read == len(meet) < len(manifest)


def test_ranges_cover_and_are_few(spark):
    rng, points = random.Random(1), []
    for _ in range(50):
        s, w = rng.uniform(-90, 89), rng.uniform(-180, 179)
        box = (s, w, min(90.0, s + rng.choice([0.001, 0.3, 20])), min(180.0, w + rng.choice([0.001, 0.3, 60])))
        ranges = z_ranges(*box)
        assert 1 <= len(ranges) <= 64
        assert all(b < c for (_, b), (c, _) in zip(ranges, ranges[1:])) and ranges[-1][1] < 1 << 2 * BITS
        inside = [(rng.uniform(box[0], box[2]), rng.uniform(box[1], box[3])) for _ in range(20)] + [box[:2], box[2:]]
        points += [(lat, lon, ranges) for lat, lon in inside]
    keys = spark.createDataFrame([(i, *p[:2]) for i, p in enumerate(points)], "i int, latitude double, longitude double")
    for r in keys.select("i", z_key().alias("z")).collect():
        assert any(a <= r["z"] <= b for a, b in points[r["i"]][2])


def test_boxes_of_a_circle():
    assert len(circle_boxes(10.0, 179.9, 50.0)) == 2 and len(circle_boxes(10.0, -179.9, 50.0)) == 2
    assert circle_boxes(89.9, 0.0, 100.0)[0][1::2] == (-180.0, 180.0)


def test_an_empty_fleet(spark):
    path = tempfile.mkdtemp(prefix="gw-geo-") + "/index"
    state = spark.createDataFrame([("a", None, None, "active")], SCHEMA)
    write_geo_index(state, path)
    index = GeoIndex(spark, path, state.schema)
    assert index.in_bounds(-90, -180, 90, 180).count() == 0 and index.nearest(0, 0, 3).count() == 0
