"""The per-vehicle state machine ping by ping, for streams.

``VehicleStep.step`` is the whole machine as one function over one ping:
streams run it inside ``transformWithStateInPandas`` (``streaming/live.py``).
Batch queries compute the same values as window expressions (``machine.py``)
and, for the speed anchor, in ``speed.py``; ``lifecycle`` runs this step over a
batch so that tests can hold the two forms against each other.

Sequential reading of the reference (it is racy across operators; this is
the consistent order): late filter, geofence, distance/halt, trip reset,
average gate with status write, speed.
"""

from __future__ import annotations

import math
from dataclasses import astuple, dataclass, fields

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ..config import DEFAULT, FleetConfig
from ..functions.geo import distance_from_center_km
from .parse import finite_positions

DEG_TO_RAD = 0.017453292519943295

# --- fixed values: event-log texts of the reference ---
MSG_AREA_WARN = "[Warning: Area Violation] Taxi Id:{id} exceeded 10km zone."
MSG_REMOVED = "[Removal Alert] Taxi Id:{id} removed after exceeding 15km zone. Area violations: {n}."
MSG_HALTED = "[Warning] Taxi ID:{id} has been halted for more than 3 minutes."
MSG_RESUMED = "Taxi ID:{id} resumed movement and is marked as active."
MSG_ACTIVE_FROM = {
    "inactive": "[Status Update] Taxi Id:{id} is now ACTIVE (previously inactive).",
    "removed": "[Status Update] Taxi Id:{id} is now ACTIVE (after being removed due to area violation).",
    "halted": "[Status Update] Taxi Id:{id} is now ACTIVE (previously halted).",
    None: "[Status Update] Taxi Id:{id} is now ACTIVE.",
}
MSG_INACTIVE_NEW = "[Status Update] {id}is now INACTIVE."
MSG_SPEEDING = "[Speeding Alert] Taxi Id:{id} is speeding. Violation count: {n}."


def haversine(lat1: float, lon1: float, lat2: float, lon2: float, r: float) -> float:
    hl = ((lat2 - lat1) * DEG_TO_RAD) / 2
    hn = ((lon2 - lon1) * DEG_TO_RAD) / 2
    a = (math.sin(hl) * math.sin(hl)
         + math.cos(lat1 * DEG_TO_RAD) * math.cos(lat2 * DEG_TO_RAD) * math.sin(hn) * math.sin(hn))
    return r * (2 * math.atan2(math.sqrt(a), math.sqrt(1 - a)))


def round2(x: float) -> float:
    return math.floor(x * 100.0 + 0.5) / 100.0


@dataclass(slots=True)
class VehicleState:
    """Everything the machine remembers about one vehicle."""
    max_ts: int | None = None          # T3 newest accepted ts
    area_count: int = 0                # T6
    warned: bool = False               # T7 beyond 10 km
    has_last: bool = False             # distance: last location kept
    last_lat: float = 0.0
    last_lon: float = 0.0
    last_ts: int = 0
    tot_cents: int = 0                 # T11 trip total in cents
    tot_s: int = 0                     # T12 trip seconds
    halt_s: int = 0                    # T13 cumulative still seconds
    halted: bool = False
    status: str | None = None          # V2
    stored_cents: int = 0              # V5 stored total of the vehicle
    has_anchor: bool = False           # T18 speed anchor
    anchor_lat: float = 0.0
    anchor_lon: float = 0.0
    anchor_ts: int = 0
    speeding_count: int = 0            # T20

    def as_tuple(self) -> tuple:
        return astuple(self)


STATE_SCHEMA = T.StructType([
    T.StructField("max_ts", T.LongType()), T.StructField("area_count", T.LongType()),
    T.StructField("warned", T.BooleanType()), T.StructField("has_last", T.BooleanType()),
    T.StructField("last_lat", T.DoubleType()), T.StructField("last_lon", T.DoubleType()),
    T.StructField("last_ts", T.LongType()), T.StructField("tot_cents", T.LongType()),
    T.StructField("tot_s", T.LongType()), T.StructField("halt_s", T.LongType()),
    T.StructField("halted", T.BooleanType()), T.StructField("status", T.StringType()),
    T.StructField("stored_cents", T.LongType()), T.StructField("has_anchor", T.BooleanType()),
    T.StructField("anchor_lat", T.DoubleType()), T.StructField("anchor_lon", T.DoubleType()),
    T.StructField("anchor_ts", T.LongType()), T.StructField("speeding_count", T.LongType()),
])
assert [f.name for f in fields(VehicleState)] == STATE_SCHEMA.names

EVENT = T.StructType([T.StructField("sub", T.IntegerType()), T.StructField("kind", T.StringType()),
                      T.StructField("message", T.StringType())])

IN_COLS = ["taxi_id", "event_id", "arrival_key", "ts_ms", "latitude", "longitude", "end_flag",
           "produced_ts", "d_center_km"]

OUT_SCHEMA = T.StructType([
    T.StructField("taxi_id", T.StringType()), T.StructField("event_id", T.LongType()),
    T.StructField("arrival_key", T.LongType()), T.StructField("ts_ms", T.LongType()),
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("end_flag", T.BooleanType()), T.StructField("produced_ts", T.DoubleType()),
    T.StructField("d_center_km", T.DoubleType()),
    T.StructField("kind", T.StringType()),             # late | discarded | forwarded
    T.StructField("area_violations", T.LongType()),
    T.StructField("area_event", T.StringType()),       # warn | reset
    T.StructField("warned", T.BooleanType()),
    T.StructField("step_km", T.DoubleType()), T.StructField("step_s", T.LongType()),
    T.StructField("halt_event", T.StringType()),       # halt | resume
    T.StructField("halted", T.BooleanType()),
    T.StructField("total_distance_km", T.DoubleType()), T.StructField("total_time_s", T.LongType()),
    T.StructField("trip_reset", T.StringType()),       # end_flag | removal
    T.StructField("avg_reason", T.StringType()),       # ok | average_skipped | average_unrealistic
    T.StructField("average_speed_kmph", T.DoubleType()),
    T.StructField("speed_reason", T.StringType()),     # first | ok | speed_skipped | speed_unrealistic
    T.StructField("speed_kmph", T.DoubleType()), T.StructField("is_speeding", T.BooleanType()),
    T.StructField("speeding_count", T.LongType()),
    T.StructField("status_before", T.StringType()), T.StructField("status", T.StringType()),
    T.StructField("fleet_delta_cents", T.LongType()), T.StructField("stored_total", T.DoubleType()),
    T.StructField("events", T.ArrayType(EVENT)),
])
OUT_COLS = OUT_SCHEMA.names


class VehicleStep:
    """One ping through the machine: ``step(state, row) -> output row``."""

    def __init__(self, cfg: FleetConfig = DEFAULT):
        self.cfg = cfg

    def _set_halt(self, st: VehicleState, halted: bool, tid: str, ev: list):
        """Status effect of a halt / resume; ignored while removed."""
        if st.status == "removed":
            return
        if halted and st.status != "halted":
            st.status = "halted"
            ev.append("halt", MSG_HALTED.format(id=tid))
        elif not halted and st.status != "active":
            st.status = "active"
            ev.append("resume", MSG_RESUMED.format(id=tid))

    def step(self, st: VehicleState, r: tuple) -> tuple:
        """``r`` holds the ``IN_COLS`` values; returns the ``OUT_COLS`` values."""
        cfg = self.cfg
        tid, _eid, _ak, ts, lat, lon, end, _pt, d = r
        ts, end = int(ts), bool(end)
        status_before = st.status
        kind = area_event = step_km = step_s = halt_event = None
        total_km = total_s = trip_reset = avg_reason = avg = None
        speed_reason = spd_out = speeding_out = None
        fleet_delta = 0
        ev = _Events()

        # Drop pings older than the newest accepted one (ties kept)
        if st.max_ts is not None and ts < st.max_ts:
            kind = "late"
        else:
            st.max_ts = ts
            if d > cfg.remove_radius_km:
                # Beyond 15 km -> removed, stored total zeroed, not forwarded
                kind = "discarded"
                st.area_count += 1
                if st.status != "removed":
                    st.status = "removed"
                    ev.append("removal", MSG_REMOVED.format(id=tid, n=st.area_count))
                st.stored_cents = 0
            else:
                kind = "forwarded"
                # 10 km warning / reset
                if d <= cfg.warn_radius_km and st.warned:
                    st.warned = False
                    area_event = "reset"
                if d > cfg.warn_radius_km and not st.warned:
                    st.warned = True
                    area_event = "warn"
                    ev.append("area_warning", MSG_AREA_WARN.format(id=tid))

                # Step from the last kept location, totals, halts, fleet total
                if st.has_last:
                    dist = haversine(st.last_lat, st.last_lon, lat, lon, cfg.earth_radius_km)
                    dms = ts - st.last_ts
                    secs = dms // 1000 if dms > 0 else 0
                    st.tot_s += secs
                    step_km, step_s = dist, secs
                    if dist > 0:
                        st.tot_cents += math.floor(dist * 100 + 0.5)
                        fleet_delta = max(0, st.tot_cents - st.stored_cents)
                        st.stored_cents = st.tot_cents
                    if dist < cfg.min_distance_km:
                        st.halt_s += secs
                        if not st.halted and st.halt_s >= cfg.halt_after_s:
                            st.halted = True
                            halt_event = "halt"
                            self._set_halt(st, True, tid, ev)
                    elif st.halted:
                        st.halted = False
                        halt_event = "resume"
                        self._set_halt(st, False, tid, ev)

                # Emit the totals, then clear at trip end or while removed
                written_cents = st.tot_cents
                total_km, total_s = written_cents / 100.0, st.tot_s
                if end or st.status == "removed":
                    trip_reset = "end_flag" if end else "removal"
                    st.has_last, st.tot_cents, st.tot_s = False, 0, 0
                else:
                    st.has_last, st.last_lat, st.last_lon, st.last_ts = True, lat, lon, ts

                # T17 + status write (V1/V2): only a passing stats row reaches the store
                if total_s < cfg.min_time_s or total_km < cfg.min_distance_km:
                    avg_reason = "average_skipped"
                else:
                    a = round2(total_km / (total_s / 3600.0))
                    if a > cfg.max_speed_kmph:
                        avg_reason = "average_unrealistic"
                    else:
                        avg_reason, avg = "ok", a
                        st.stored_cents = written_cents
                        if end:
                            if st.status != "inactive":
                                if st.status is None:
                                    ev.append("inactive", MSG_INACTIVE_NEW.format(id=tid))
                                st.status = "inactive"
                        elif st.status not in ("halted", "active"):
                            ev.append("active", MSG_ACTIVE_FROM[st.status].format(id=tid))
                            st.status = "active"

                # Speed against the anchor (ignores the status); a
                # skipped ping neither moves nor clears the anchor
                moves = True
                if st.has_anchor:
                    dkm = haversine(st.anchor_lat, st.anchor_lon, lat, lon, cfg.earth_radius_km)
                    dt = (ts - st.anchor_ts) / 1000.0
                    if dt < cfg.min_time_s or dkm < cfg.min_distance_km:
                        speed_reason, moves = "speed_skipped", False
                    else:
                        spd = math.floor((dkm / dt) * 3600 * 100.0 + 0.5) / 100.0
                        if spd >= cfg.max_speed_kmph:
                            speed_reason, moves = "speed_unrealistic", False
                        else:
                            speeding = spd > cfg.speed_limit_kmph
                            speed_reason, spd_out, speeding_out = "ok", spd, speeding
                            if speeding:
                                st.speeding_count += 1
                                ev.append("speeding", MSG_SPEEDING.format(id=tid, n=st.speeding_count))
                else:
                    speed_reason = "first"
                if moves:
                    if end:
                        st.has_anchor, st.speeding_count = False, 0
                    else:
                        st.has_anchor, st.anchor_lat, st.anchor_lon, st.anchor_ts = True, lat, lon, ts

        return (*r, kind, st.area_count, area_event, st.warned, step_km, step_s, halt_event, st.halted,
                total_km, total_s, trip_reset, avg_reason, avg, speed_reason, spd_out, speeding_out,
                st.speeding_count, status_before, st.status, fleet_delta, st.stored_cents / 100.0, ev.items)


class _Events:
    __slots__ = ("items",)

    def __init__(self):
        self.items = []

    def append(self, kind: str, message: str):
        self.items.append({"sub": len(self.items), "kind": kind, "message": message})


def run_sorted(batches, cfg: FleetConfig = DEFAULT):
    """``mapInPandas`` body: batches of one partition sorted by vehicle, arrival.

    Only the current vehicle's state is held; its rows arrive batch by batch.
    """
    machine = VehicleStep(cfg)
    key, st = None, None
    for pdf in batches:
        if pdf.empty:
            continue
        outs = []
        step = machine.step
        for r in zip(*[pdf[c].tolist() for c in IN_COLS]):
            if r[0] != key:
                key, st = r[0], VehicleState()
            outs.append(step(st, r))
        yield pd.DataFrame(outs, columns=OUT_COLS)


def with_center_distance(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """T4 in the JVM, before the rows go to Python; pings without a finite position are dropped."""
    return finite_positions(pings).withColumn("d_center_km", distance_from_center_km("latitude", "longitude", cfg))


def lifecycle(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """One output row per ping (``OUT_SCHEMA``): the step over a batch, one
    task per vehicle, in bounded memory. The reference form for tests."""
    df = with_center_distance(pings, cfg).select(*IN_COLS)
    n = int(pings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df = df.repartition(n, "taxi_id").sortWithinPartitions("taxi_id", "arrival_key", "event_id")
    return df.mapInPandas(lambda it: run_sorted(it, cfg), schema=OUT_SCHEMA)
