"""Sinks of the live path (S9–S15) without a table format.

The reference upserts hashes, sets and lists in a key-value store per record.
Here every micro-batch of per-ping outputs is written once by ``foreachBatch``:

* ``append_batch``: append-only tables (event log, grid snapshots, per-ping
  outputs) partitioned by batch id; dynamic partition overwrite makes a replay
  idempotent.
* the served vehicle state is appended too, as one partial state per vehicle
  and batch, and merged on read (newest field group wins), so a batch costs what
  it holds and not the fleet. ``compact_vehicle_state`` bounds the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..operators.counters import status_changes
from ..operators.grid import grid_snapshot
from ..operators.log_ranges import append_log
from ..operators.views import flatten_state, merge_vehicle_state, vehicle_state_partial


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def append_batch(batch: DataFrame, batch_id: int, path: str) -> None:
    """Append-only sink: rows of one micro-batch under ``batch_id=<n>``."""
    (batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_vehicle_state(spark: SparkSession, root: str) -> DataFrame:
    """One row per vehicle, merged from the appended partial states."""
    return flatten_state(merge_vehicle_state(spark.read.parquet(f"{root}/state").drop("batch_id")))


def compact_vehicle_state(spark: SparkSession, root: str, target: str) -> None:
    """Write the merged partial states as a new table: one row per vehicle, to
    which a restarted sink may go on appending."""
    (merge_vehicle_state(spark.read.parquet(f"{root}/state").drop("batch_id"))
     .withColumn("batch_id", F.lit(-1).cast("long")).write.mode("overwrite").partitionBy("batch_id").parquet(target))


def state_sinks(root: str, log_width: int | None = None):
    """``foreachBatch`` function writing the vehicle-state views of one batch:

    * ``state``: S9–S11 (position, update time, totals, speed fields, status),
      a partial state per vehicle of the batch;
    * ``events``: S12 event log (one row per message), or with ``log_width`` the
      ``log`` by arrival ranges of that width (``operators/log_ranges.py``);
    * ``status_changes``: the deltas of the status counters (V3 over time);
    * ``pings``: the per-ping outputs (input of the grid stream and audits).
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            # End-to-end latency against the producer's stamp, at write time
            latency = F.unix_millis(F.current_timestamp()) - (F.col("produced_ts") * 1000).cast("long")
            append_batch(batch.drop("events").withColumn("latency_ms", latency), batch_id, f"{root}/pings")
            ev = batch.select("taxi_id", "event_id", "arrival_key", F.explode("events").alias("e")).select(
                "taxi_id", "event_id", "arrival_key", "e.sub", "e.kind", "e.message")
            if log_width:
                append_log(ev, batch_id, f"{root}/log", log_width)
            else:
                append_batch(ev, batch_id, f"{root}/events")
            append_batch(status_changes(batch), batch_id, f"{root}/status_changes")
            append_batch(vehicle_state_partial(batch), batch_id, f"{root}/state")
        finally:
            batch.unpersist()
    return write


def grid_sinks(root: str, cfg: FleetConfig = DEFAULT):
    """``foreachBatch`` for closed grid windows: snapshot rows
    appended; ``grid.recent_grids`` over the table gives the recency order (G6)."""
    def write(batch: DataFrame, batch_id: int) -> None:
        append_batch(grid_snapshot(batch, cfg), batch_id, f"{root}/grids")
    return write


def start_fresh(spark: SparkSession, root: str) -> None:
    """Clear every output of a sink folder before a fresh start (a new
    query checkpoint replays the topic from the earliest offset). A restart
    that resumes from an existing checkpoint must not call this: its sinks
    are idempotent and continue where they stopped."""
    fs, p, jvm = _fs(spark, root.rstrip("/"))
    for name in ("state", "pings", "events", "log", "status_changes", "grids"):
        sub = jvm.org.apache.hadoop.fs.Path(p, name)
        if fs.exists(sub):
            fs.delete(sub, True)


def console_sink(df: DataFrame, truncate: bool = False):
    """Print lines on the driver console (debugging only)."""
    return df.writeStream.format("console").option("truncate", truncate)
