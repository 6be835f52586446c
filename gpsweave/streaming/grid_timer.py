"""G3 live variant: a cell's window opens with its first record and closes
``window`` later in processing time (the reference's timer semantics).

Keyed by cell: map state holds the latest speed of each vehicle seen since the
window opened; a processing-time timer fires the window, which emits one
snapshot row (mean over vehicles, vehicle count, status, bounds) and clears
the state. A vehicle moving between cells counts in each cell it was seen in,
as in the reference. Results depend on arrival timing, so the deterministic
event-time form (``operators/grid.grid_window``) is the one checked against
SQL; this one is tested for its protocol.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import DEFAULT, FleetConfig
from ..operators.grid import STATUS_RULES, with_grid_id

SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("grid_id", T.StringType()), T.StructField("bottom_left_lat", T.DoubleType()),
    T.StructField("bottom_left_lon", T.DoubleType()), T.StructField("top_right_lat", T.DoubleType()),
    T.StructField("top_right_lon", T.DoubleType()), T.StructField("avg_speed_kmph", T.DoubleType()),
    T.StructField("avg_speed_text", T.StringType()), T.StructField("vehicles", T.LongType()),
    T.StructField("traffic_status", T.StringType()), T.StructField("updated_at_ms", T.LongType())])


def _status(avg: float, n: int) -> str:
    return next((name for name, below, least in STATUS_RULES if avg < below and n >= least), "FREE_FLOW")


def _window_ms(cfg: FleetConfig) -> int:
    num, unit = cfg.grid_window.split()
    return int(float(num) * {"second": 1000, "seconds": 1000, "minute": 60000, "minutes": 60000,
                             "hour": 3600000, "hours": 3600000, "day": 86400000}[unit])


class GridCellProcessor(StatefulProcessor):
    """``groupBy('grid_id').transformWithStateInPandas(GridCellProcessor(cfg), ...,
    timeMode='ProcessingTime')``."""

    def __init__(self, cfg: FleetConfig = DEFAULT):
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.speeds = handle.getMapState("speeds", "taxi_id string", "speed_kmph double")
        self.timer = handle.getValueState("timer", "expires long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        # batch by batch: of a vehicle's speeds only the latest by arrival is kept
        newest: dict = {}
        for pdf in rows:
            for tid, at, spd in zip(pdf["taxi_id"].tolist(), zip(pdf["arrival_key"].tolist(), pdf["event_id"].tolist()), pdf["speed_kmph"].tolist()):
                if tid not in newest or newest[tid][0] <= at:
                    newest[tid] = (at, float(spd))
        for tid, (_, spd) in newest.items():
            self.speeds.updateValue((tid,), (spd,))
        if not self.timer.exists():
            expires = timerValues.getCurrentProcessingTimeInMs() + _window_ms(self.cfg)
            self.handle.registerTimer(expires)
            self.timer.update((expires,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        speeds = [v[0] for v in self.speeds.values()]
        self.speeds.clear()
        self.timer.clear()
        if not speeds:
            return
        c = self.cfg
        gid = key[0]
        lat_i, lon_i = (int(x) for x in gid.split("_"))
        bl_lat = c.grid_min_lat + lat_i * c.lat_delta
        bl_lon = c.grid_min_lon + lon_i * c.lon_delta
        avg = sum(speeds) / len(speeds)
        yield pd.DataFrame([(gid, bl_lat, bl_lon, bl_lat + c.lat_delta, bl_lon + c.lon_delta, avg,
                             f"{avg:.2f}", len(speeds), _status(avg, len(speeds)),
                             expiredTimerInfo.getExpiryTimeInMs())], columns=SNAPSHOT_SCHEMA.names)

    def close(self) -> None:
        pass


def grid_timer_stream(vehicle_out: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Live G3–G5 with the reference's processing-time windows."""
    speeds = with_grid_id(vehicle_out.filter(F.col("speed_reason") == "ok"), cfg).select(
        "grid_id", "taxi_id", "arrival_key", "event_id", "speed_kmph")
    return speeds.groupBy("grid_id").transformWithStateInPandas(
        statefulProcessor=GridCellProcessor(cfg), outputStructType=SNAPSHOT_SCHEMA,
        outputMode="Append", timeMode="ProcessingTime")
