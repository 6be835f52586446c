"""Instantaneous speed against an anchor.

The anchor is the last forwarded ping that passed the speed gates, so whether a
ping passes depends on which earlier ones did: the one quantity of the pipeline
that no running aggregate gives. Pings are classified in the JVM (``kinds``);
only forwarded ones and the columns the step needs go to Python, in Arrow
batches sorted by vehicle and arrival. One vehicle is one sequence and streams
through one task, with the anchor as its only state."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from .lifecycle import DEG_TO_RAD
from .machine import kinds

SCHEMA = ("taxi_id string, event_id long, arrival_key long, ts_ms long, latitude double, longitude double, "
          "speed_reason string, speed_kmph double, is_speeding boolean, speeding_no long, speeding_count long")
_IN = ["taxi_id", "event_id", "arrival_key", "ts_ms", "latitude", "longitude", "end_flag"]


def anchor_step(cfg: FleetConfig):
    """One ping against the anchor, (latitude, longitude, time) or None: reason,
    speed, speeding, outputs of the trip up to it, the anchor and outputs kept
    after it, and whether it was accepted (moved the anchor)."""
    r, limit, top, min_s, min_km = cfg.earth_radius_km, cfg.speed_limit_kmph, cfg.max_speed_kmph, cfg.min_time_s, cfg.min_distance_km
    sin, cos, sqrt, atan2, floor = math.sin, math.cos, math.sqrt, math.atan2, math.floor

    def step(anchor, count, ts, lat, lon, end):
        reason, speed, fast, moves = "first", None, None, True
        if anchor is not None:
            alat, alon, ats = anchor
            a = sin(((lat - alat) * DEG_TO_RAD) / 2)
            b = sin(((lon - alon) * DEG_TO_RAD) / 2)
            h = a * a + cos(alat * DEG_TO_RAD) * cos(lat * DEG_TO_RAD) * b * b
            km = r * (2 * atan2(sqrt(h), sqrt(1 - h)))
            s = (ts - ats) / 1000.0
            if s < min_s or km < min_km:
                reason, moves = "speed_skipped", False
            else:
                speed = floor((km / s) * 3600 * 100.0 + 0.5) / 100.0
                if speed >= top:
                    reason, speed, moves = "speed_unrealistic", None, False
                else:
                    reason, fast = "ok", speed > limit
                    count += fast
        number = count
        if moves:
            anchor, count = (None, 0) if end else ((lat, lon, ts), count)
        return reason, speed, fast, number, anchor, count, moves
    return step


def _speeds(cfg: FleetConfig):
    step = anchor_step(cfg)

    def run(batches):
        vehicle, anchor, count = None, None, 0
        for batch in batches:
            reasons, speeds, flags, numbers, counts = [], [], [], [], []
            for tid, ts, lat, lon, end in zip(*(batch.column(_IN.index(k)).to_pylist() for k in ("taxi_id", "ts_ms", "latitude", "longitude", "end_flag"))):
                if tid != vehicle:
                    vehicle, anchor, count = tid, None, 0
                reason, speed, fast, number, anchor, count, _ = step(anchor, count, ts, lat, lon, end)
                reasons.append(reason)
                speeds.append(speed)
                flags.append(fast)
                numbers.append(number)
                counts.append(count)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:6], pa.array(reasons, pa.string()), pa.array(speeds, pa.float64()),
                 pa.array(flags, pa.bool_()), pa.array(numbers, pa.int64()), pa.array(counts, pa.int64())],
                [*_IN[:6], "speed_reason", "speed_kmph", "is_speeding", "speeding_no", "speeding_count"])
    return run


def alert_text():
    """Text of a speeding output."""
    return F.concat(F.lit("Speeding Alert! TaxiID="), F.col("taxi_id"), F.lit(" | Speed="),
                    F.col("speed_kmph").cast("string"), F.lit(" km/h"))


def speed_chain(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """One row per forwarded ping: speed_reason (first, ok, speed_skipped,
    speed_unrealistic), speed_kmph and is_speeding where ok; speeding outputs of
    the trip up to this ping (speeding_no) and as kept after it, 0 once a trip
    ends (speeding_count)."""
    rows = kinds(pings.select(*_IN), cfg).filter("kind = 'forwarded'").select(*_IN)
    # the classifying window already partitions by vehicle; this keeps that partitioning and adds the order
    rows = rows.repartition("taxi_id").sortWithinPartitions("taxi_id", "arrival_key", "event_id")
    return rows.mapInArrow(_speeds(cfg), SCHEMA)
