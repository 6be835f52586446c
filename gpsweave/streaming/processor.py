"""The per-vehicle state machine as a Structured Streaming stateful processor.

Same ``VehicleStep`` as the batch path (``operators/lifecycle.py``); the state
of each vehicle is one entry of a map state (RocksDB state store, checkpointed
with the query). Within a micro-batch the rows of a key come in no promised
order, so they are sorted by arrival before stepping; rows that arrive in a
later micro-batch than newer ones are judged by the stored state (late pings
are dropped by the T3 rule, as in the reference).

A fleet's micro-batch is many vehicles of few pings each, and a key's calls and
data frames cost more than such a vehicle's pings. So the key is a bucket of
vehicles: a micro-batch reads and writes the entries of the vehicles it holds.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import DEFAULT, FleetConfig
from ..operators.lifecycle import IN_COLS, OUT_COLS, STATE_SCHEMA, VehicleState, VehicleStep

BUCKETS = 2048        # of vehicles; a checkpoint keeps the number it was made with
FRAME_ROWS = 10_000   # outputs given back at a time


class VehicleProcessor(StatefulProcessor):
    """``groupBy(<bucket of taxi_id>).transformWithStateInPandas(VehicleProcessor(cfg), ...)``."""

    def __init__(self, cfg: FleetConfig = DEFAULT):
        self.cfg = cfg

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.vehicles = handle.getMapState("vehicles", "taxi_id string", STATE_SCHEMA)
        self.machine = VehicleStep(self.cfg)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        pdf = pdf.sort_values(["taxi_id", "arrival_key", "event_id"], kind="stable")
        outs = []
        for vehicle, pings in groupby(zip(*[pdf[c].tolist() for c in IN_COLS]), key=lambda r: r[0]):
            saved = self.vehicles.getValue((vehicle,))
            st = VehicleState(*saved) if saved is not None else VehicleState()
            for r in pings:
                outs.append(self.machine.step(st, r))
                if len(outs) >= FRAME_ROWS:
                    yield _frame(outs)
                    outs = []
            self.vehicles.updateValue((vehicle,), st.as_tuple())
        yield _frame(outs)

    def close(self) -> None:
        pass


def _frame(outs: list[tuple]) -> pd.DataFrame:
    # object columns: whole numbers stay whole beside nulls
    return pd.DataFrame(outs, columns=OUT_COLS, dtype=object)
