"""V3 over time: the counters of the status sets after every change.

The reference moves a vehicle between status sets and counts up and down as its
status changes. A change is a delta: -1 for the status left, +1 for the one
entered. The counters are a running sum of the deltas over the whole fleet, one
key for all rows, so its carries come down a tree (``plans/scan.py``). Streams
append the same deltas with every micro-batch (``streaming/sinks.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT
from ..functions.num import idiv
from ..plans.scan import Running, keyed_scan
from .views import ORDER_COLS, STATUSES

CHUNK = 4096   # arrival positions a chunk


def status_changes(rows: DataFrame) -> DataFrame:
    """The pings that changed a vehicle's status, from per-ping rows with
    ``status_before`` and ``status``. A vehicle's first status leaves none."""
    return rows.filter("NOT status <=> status_before").select("taxi_id", *ORDER_COLS, "status_before", "status")


def status_count_series(changes: DataFrame, fan_out: int = DEFAULT.scan_fan_out, chunk: int = CHUNK) -> DataFrame:
    """The changes with one column per status: vehicles in it after the change.

    Changes count in order of arrival position, ping id and vehicle. ``chunk``
    arrival positions are one chunk, ``fan_out`` bounds the rows of a window
    over chunks. An empty table gives an empty one; rows without an arrival
    position come first, as one chunk."""
    deltas = [Running(s, "sum", (F.col("status").eqNullSafe(s)).cast("long") - F.col("status_before").eqNullSafe(s).cast("long"))
              for s in STATUSES]
    at = F.coalesce(idiv(F.col("arrival_key"), chunk), F.lit(-1).cast("long"))
    return keyed_scan(changes.withColumn("_all", F.lit(1)), ["_all"], [*ORDER_COLS, "taxi_id"], at, deltas,
                      chunk_col="_schunk", fan_out=fan_out).drop("_all", "_schunk")
