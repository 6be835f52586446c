"""Stream-vs-batch parity of the state machine, with a restart midway."""

import glob
import os
import shutil
import tempfile

from pyspark.sql import functions as F

from conftest import SF001
from gpsweave.operators.lifecycle import lifecycle
from gpsweave.operators.parse import parse_pings
from gpsweave.sources import fixtures as FX
from gpsweave.operators.joins import interval_join
from gpsweave.streaming.live import file_messages, finish, grid_stream, location_speed_join_stream, vehicle_stream
from gpsweave.operators.machine import trip_chain
from gpsweave.operators.speed import speed_chain
from gpsweave.operators.views import vehicle_state
from gpsweave.config import DEFAULT
from gpsweave.operators.grid import grid_snapshot, grid_window
from gpsweave.streaming.sinks import grid_sinks, read_vehicle_state, state_sinks


def _stage_files(spark, msgs, root, per_file=250):
    """Message records as one file per arrival range, modification times in
    arrival order (the file source's order)."""
    (msgs.withColumn("part", (F.col("arrival_key") / per_file).cast("int")).repartition("part")
     .write.partitionBy("part").parquet(f"{root}/staging"))
    files = []
    for i, d in enumerate(sorted(glob.glob(f"{root}/staging/part=*"), key=lambda p: int(p.split("=")[1]))):
        for j, f in enumerate(sorted(glob.glob(f"{d}/*.parquet"))):
            files.append((i, j, f))
    return files


def _publish(files, dst):
    os.makedirs(dst, exist_ok=True)
    for i, j, f in files:
        out = f"{dst}/{i:04d}_{j}.parquet"
        shutil.copy(f, out)
        os.utime(out, (1_600_000_000 + 10 * i, 1_600_000_000 + 10 * i))


def _run(spark, src, root):
    out = vehicle_stream(file_messages(spark, src, max_files_per_trigger=1))
    finish(out.writeStream.foreachBatch(state_sinks(f"{root}/sinks")).option("checkpointLocation", f"{root}/ckpt"))


def test_stream_matches_batch_with_restart(spark):
    root = tempfile.mkdtemp(prefix="gw-stream-")
    msgs = FX.messages(FX.trips(spark, SF001))
    files = _stage_files(spark, msgs, root)
    half = len(files) // 2
    _publish(files[:half], f"{root}/in")
    _run(spark, f"{root}/in", root)
    _publish(files[half:], f"{root}/in")          # more data arrives; restart from the checkpoint
    _run(spark, f"{root}/in", root)

    got = spark.read.parquet(f"{root}/sinks/pings").drop("batch_id", "event_time", "latency_ms")
    want = lifecycle(parse_pings(msgs, keep=["event_id", "arrival_key"])).drop("events")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0

    ev = spark.read.parquet(f"{root}/sinks/events").drop("batch_id")
    want_ev = (lifecycle(parse_pings(msgs, keep=["event_id", "arrival_key"]))
               .select("taxi_id", "event_id", "arrival_key", F.explode("events").alias("e"))
               .select("taxi_id", "event_id", "arrival_key", "e.sub", "e.kind", "e.message"))
    assert ev.exceptAll(want_ev.select(*ev.columns)).count() == 0 and ev.count() == want_ev.count()

    pings = parse_pings(msgs, keep=["event_id", "arrival_key"])
    state, batch_state = read_vehicle_state(spark, f"{root}/sinks"), vehicle_state(trip_chain(pings), speed_chain(pings))
    assert state.count() == batch_state.count()
    assert state.exceptAll(batch_state.select(*state.columns)).count() == 0      # fleet_cents included


def test_a_failing_query_raises(spark):
    import pytest
    root = tempfile.mkdtemp(prefix="gw-fail-")
    spark.createDataFrame([(1, 1, "x")], "event_id long, arrival_key long, message string").write.parquet(f"{root}/in")

    def broken(batch, batch_id):
        raise RuntimeError("sink failed")
    with pytest.raises(Exception, match="sink failed"):
        finish(file_messages(spark, f"{root}/in").writeStream.foreachBatch(broken).option("checkpointLocation", f"{root}/c"))


def test_grid_stream_over_written_outputs(spark):
    root = tempfile.mkdtemp(prefix="gw-grid-")
    msgs = FX.messages(FX.trips(spark, SF001))
    files = _stage_files(spark, msgs, root, per_file=500)
    _publish(files, f"{root}/in")
    _run(spark, f"{root}/in", root)
    pings_schema = spark.read.parquet(f"{root}/sinks/pings").schema
    live = spark.readStream.schema(pings_schema).parquet(f"{root}/sinks/pings")
    cfg = DEFAULT.with_(cell_km=5.0, grid_window="1 hour")
    finish(grid_stream(live, cfg).writeStream.outputMode("append").foreachBatch(grid_sinks(f"{root}/sinks", cfg))
           .option("checkpointLocation", f"{root}/gckpt"))
    snaps = spark.read.parquet(f"{root}/sinks/grids")
    # closed windows only: every emitted window equals the batch computation of that window
    live_rows = {(r.grid_id, r.updated_at, r.vehicles) for r in snaps.collect()}
    batch = grid_snapshot(grid_window(spark.read.parquet(f"{root}/sinks/pings")
                                      .filter(F.col("speed_reason") == "ok"), cfg, ts_col="event_time"), cfg)
    batch_rows = {(r.grid_id, r.updated_at, r.vehicles) for r in batch.collect()}
    assert live_rows and live_rows <= batch_rows
    assert spark.read.parquet(f"{root}/sinks/pings").filter(F.col("latency_ms").isNull()).count() == 0


def test_interval_join_stream_matches_batch_pairs(spark):
    root = tempfile.mkdtemp(prefix="gw-join-")
    msgs = FX.messages(FX.trips(spark, SF001))
    files = _stage_files(spark, msgs, root, per_file=500)
    _publish(files, f"{root}/in")
    _run(spark, f"{root}/in", root)
    schema = spark.read.parquet(f"{root}/sinks/pings").schema
    a = spark.readStream.schema(schema).parquet(f"{root}/sinks/pings")
    b = spark.readStream.schema(schema).parquet(f"{root}/sinks/pings")
    j = location_speed_join_stream(a, b, bound_ms=30 * 60 * 1000, watermark="2 hours")
    finish(j.writeStream.format("parquet").option("path", f"{root}/pairs").option("checkpointLocation", f"{root}/jckpt"))
    got = spark.read.parquet(f"{root}/pairs").select("event_id", "speed_event_id", "speed_kmph")
    table = spark.read.parquet(f"{root}/sinks/pings")
    want = interval_join(table.filter("kind = 'forwarded'").select("taxi_id", "event_id", "ts_ms"),
                         table.filter("speed_reason = 'ok'").select("taxi_id", "event_id", "ts_ms", F.col("speed_kmph").alias("kmph")),
                         30 * 60 * 1000).select("event_id", "speed_event_id", "speed_kmph")
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0


def test_processing_time_grid_windows_fire_and_clear(spark):
    import time
    from gpsweave.streaming.grid_timer import grid_timer_stream
    root = tempfile.mkdtemp(prefix="gw-timer-")
    msgs = FX.messages(FX.trips(spark, SF001))
    files = _stage_files(spark, msgs, root, per_file=500)
    _publish(files, f"{root}/in")
    _run(spark, f"{root}/in", root)
    schema = spark.read.parquet(f"{root}/sinks/pings").schema
    live = spark.readStream.schema(schema).parquet(f"{root}/sinks/pings")
    cfg = DEFAULT.with_(cell_km=5.0, grid_window="1 second")
    q = (grid_timer_stream(live, cfg).writeStream.format("memory").queryName("grid_timer")
         .option("checkpointLocation", f"{root}/tckpt").trigger(processingTime="500 milliseconds").start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("grid_timer").count() == 0:
            time.sleep(1)
        time.sleep(3)
    finally:
        q.stop()
    out = spark.table("grid_timer")
    # one window per cell (all speeds arrived in the first micro-batch), each fired once
    speeds = (spark.read.parquet(f"{root}/sinks/pings").filter(F.col("speed_reason") == "ok"))
    from gpsweave.operators.grid import with_grid_id
    cells = with_grid_id(speeds, cfg).groupBy("grid_id").agg(F.countDistinct("taxi_id").alias("n"))
    got = {r.grid_id: r.vehicles for r in out.collect()}
    want = {r.grid_id: r.n for r in cells.collect()}
    assert got == want


def test_a_key_holds_many_vehicles_in_one_frame():
    import pandas as pd
    from gpsweave.operators.lifecycle import IN_COLS, OUT_COLS, VehicleState, VehicleStep
    from gpsweave.streaming.processor import VehicleProcessor

    class Handle:
        def __init__(self):
            self.kept = {}

        def getMapState(self, *_):
            return self

        def getValue(self, key):
            return self.kept.get(key)

        def updateValue(self, key, value):
            self.kept[key] = value

    handle, processor = Handle(), VehicleProcessor()
    processor.init(handle)
    rows = [(str(v), i, i, 1704067200000 + 40_000 * i, 39.9 + 0.01 * (i % 5), 116.39 + 0.001 * v, False, 1.0, 3.0) for i in range(12) for v in range(50)]
    want, states, step = [], {}, VehicleStep()
    for r in rows:
        want.append(step.step(states.setdefault(r[0], VehicleState()), r))
    got = []
    for part in (rows[:300], rows[300:]):               # two micro-batches, rows in no order
        frames = list(processor.handleInputRows((0,), iter([pd.DataFrame(part[::-1][:100], columns=IN_COLS), pd.DataFrame(part[::-1][100:], columns=IN_COLS)]), None))
        assert len(frames) == 1
        got += [tuple(r) for r in frames[0].itertuples(index=False)]
    plain = lambda rows: sorted(repr([v for c, v in zip(OUT_COLS, r)]) for r in rows)
    assert plain(got) == plain(want)
    assert handle.kept == {(v,): st.as_tuple() for v, st in states.items()}
