"""Physical-plan properties the design relies on."""

import re

from conftest import SF001
from gpsweave.catalog import queries


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _stored_pings(spark, tmp_path):
    from gpsweave.sources.fixtures import trips
    queries()["geofence_discard"](spark, SF001)  # warm the session
    path = str(tmp_path / "pings")
    trips(spark, SF001).write.parquet(path)
    return spark.read.parquet(path)


def test_trip_chain_is_one_scan_one_shuffle_no_python(spark, tmp_path):
    from gpsweave.operators.machine import trip_chain
    plan = _plan(trip_chain(_stored_pings(spark, tmp_path)))
    assert not re.search(r"Python|Pandas|Arrow", plan)
    assert len(re.findall(r"FileScan parquet", plan)) == 1
    assert len(re.findall(r"Exchange", plan)) == 1 and len(re.findall(r"\bSort \[", plan)) == 1


def test_speed_chain_sends_only_its_columns_to_python(spark, tmp_path):
    from gpsweave.operators.speed import speed_chain
    plan = _plan(speed_chain(_stored_pings(spark, tmp_path)))
    scan = re.search(r"ReadSchema: struct<([^>\n]*)", plan).group(1)
    assert "produced_ts" not in scan and "value" not in scan
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_scans_prune_columns(spark):
    plan = _plan(queries()["interval_metrics"](spark, SF001))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all("props" not in s and "user_id" not in s for s in schemas)


def test_trip_views_run_no_python(spark):
    for name in ("status_counts", "fleet_distance", "average_speed", "removal_events"):
        assert not re.search(r"Python|Pandas|MapInArrow", _plan(queries()[name](spark, SF001))), name


def test_hot_keys_are_not_windowed_or_collected(spark):
    for name in ("grid_moves", "location_speed_interval_join", "add_end_flag"):
        plan = _plan(queries()[name](spark, SF001))
        assert "collect_list" not in plan, name
    assert not re.search(r"\bWindow \[", _plan(queries()["grid_window"](spark, SF001)).split("Window [_n")[0].split("Aggregate")[0])


def test_an_id_lookup_filters_before_the_speed_anchor(spark):
    plan = _plan(queries()["vehicle_lookup_by_id"](spark, SF001))
    below = plan[plan.index("MapInArrow"):]
    assert re.search(r"Filter .*= 7\)", below)
