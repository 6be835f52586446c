"""T1 with event-time timers: the state of a vehicle idle beyond a limit is
flushed and given up; its next ping starts anew.

Every vehicle with state has one timer, at its newest event time plus the
limit. It fires once the watermark has passed it, so a fleet's state is bounded
by the vehicles seen within the limit and the watermark's delay. A ping beyond
the limit may come before the watermark gets there: it closes the old session
itself. Either way the same row says so, so results don't depend on how the
pings fall into micro-batches as long as no ping is later than the watermark
allows (Spark drops those before they reach the state).

A session ends with a row of kind ``expired``: no ``event_id``, the expiry as
``ts_ms``, and what the state held (totals of the open trip, violations, stored
total). TTL on state variables counts processing time only, so it isn't used.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import DEFAULT, FleetConfig
from ..operators.lifecycle import IN_COLS, OUT_COLS, OUT_SCHEMA, STATE_SCHEMA, VehicleState, VehicleStep, with_center_distance
from ..operators.parse import parse_pings
from .sinks import append_batch

SESSION_OUT_SCHEMA = T.StructType(OUT_SCHEMA.fields + [T.StructField("session_start_ms", T.LongType())])


class ExpiringVehicleProcessor(StatefulProcessor):
    """``groupBy('taxi_id').transformWithStateInPandas(..., timeMode='EventTime')``."""

    def __init__(self, idle_ms: int, cfg: FleetConfig = DEFAULT):
        self.idle_ms, self.cfg = idle_ms, cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("vehicle", STATE_SCHEMA)
        self.session = handle.getValueState("session", "start long")
        self.machine = VehicleStep(self.cfg)

    def _frame(self, rows: list) -> pd.DataFrame:
        # object columns: whole numbers stay whole beside nulls
        return pd.DataFrame(rows, columns=SESSION_OUT_SCHEMA.names, dtype=object)

    def _expired(self, vehicle: str, st: VehicleState, start: int) -> tuple:
        row = dict.fromkeys(OUT_COLS) | {
            "taxi_id": vehicle, "ts_ms": st.max_ts + self.idle_ms, "kind": "expired", "area_violations": st.area_count,
            "warned": st.warned, "halted": st.halted, "total_distance_km": st.tot_cents / 100.0, "total_time_s": st.tot_s,
            "speeding_count": st.speeding_count, "status_before": st.status, "stored_total": st.stored_cents / 100.0, "events": []}
        return (*row.values(), start)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True).sort_values(["arrival_key", "event_id"], kind="stable")
        st, start, timer = VehicleState(), None, None
        if self.state.exists():
            st, start = VehicleState(*self.state.get()), self.session.get()[0]
            timer = st.max_ts + self.idle_ms
        outs = []
        for r in zip(*[pdf[c].tolist() for c in IN_COLS]):
            ts = int(r[IN_COLS.index("ts_ms")])
            if start is not None and ts - st.max_ts > self.idle_ms:
                outs.append(self._expired(key[0], st, start))
                st, start = VehicleState(), None
            start = ts if start is None else start
            outs.append((*self.machine.step(st, r), start))
        self.state.update(st.as_tuple())
        self.session.update((start,))
        if timer != st.max_ts + self.idle_ms:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(st.max_ts + self.idle_ms)
        yield self._frame(outs)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        st, start = VehicleState(*self.state.get()), self.session.get()[0]
        if st.max_ts + self.idle_ms != expiredTimerInfo.getExpiryTimeInMs():
            return    # newer pings have moved the expiry
        self.state.clear()
        self.session.clear()
        yield self._frame([self._expired(key[0], st, start)])

    def close(self) -> None:
        pass


def expiring_vehicle_stream(messages: DataFrame, idle_ms: int, watermark: str, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Per-ping outputs and session ends (``SESSION_OUT_SCHEMA``), streaming."""
    pings = with_center_distance(parse_pings(messages, keep=["event_id", "arrival_key"]), cfg).select(*IN_COLS)
    pings = pings.withColumn("event_time", F.timestamp_millis("ts_ms")).withWatermark("event_time", watermark)
    return pings.groupBy("taxi_id").transformWithStateInPandas(
        statefulProcessor=ExpiringVehicleProcessor(idle_ms, cfg), outputStructType=SESSION_OUT_SCHEMA,
        outputMode="Append", timeMode="EventTime")


def session_sinks(root: str):
    """``foreachBatch`` function appending outputs and session ends of a batch."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(batch.drop("events"), batch_id, f"{root}/sessions")
    return write
