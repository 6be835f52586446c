"""Idle vehicles expire (T1): after more than ``idle_ms`` of event time without a
ping a vehicle's state is given up, and its next ping starts anew.

A session is what lies between two such gaps. It is named by the time of its
first ping, so it needs no counter that outlives the state. Gaps are measured
from the newest ping seen so far; a ping that arrives late belongs to the
session that is open when it arrives, and is judged late there (T3). The trip
machine over (vehicle, session) is the machine whose state expires; sessions
also part a vehicle's rows into smaller keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..plans.scan import Running, keyed_scan, row_chunks
from .machine import trip_chain
from .parse import finite_positions
from .trips import KEY, ORDER


def with_sessions(pings: DataFrame, idle_ms: int, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Adds ``session_start_ms``. Two chunked scans in the same chunks: starts
    rise within a vehicle, so the running maximum of starts is the open session's."""
    df = row_chunks(finite_positions(pings), KEY, "arrival_key", cfg.scan_chunk_rows)
    df = keyed_scan(df, KEY, ORDER, F.col("_chunk"), [Running("_newest", "max", F.col("ts_ms"), inclusive=False)])
    starts = F.when(F.col("_newest").isNull() | (F.col("ts_ms") - F.col("_newest") > idle_ms), F.col("ts_ms"))
    df = keyed_scan(df, KEY, ORDER, F.col("_chunk"), [Running("session_start_ms", "max", starts)])
    return df.select(*pings.columns, "session_start_ms")


def vehicle_sessions(pings: DataFrame, idle_ms: int, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """One row per session: vehicle, start, newest event time, pings (late ones
    too), and the time from which the session counts as expired."""
    return (with_sessions(pings, idle_ms, cfg).groupBy("taxi_id", "session_start_ms")
            .agg(F.max("ts_ms").alias("newest_ms"), F.count(F.lit(1)).alias("pings"))
            .withColumn("expires_ms", F.col("newest_ms") + idle_ms))


def trip_chain_with_expiry(pings: DataFrame, idle_ms: int, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """``trip_chain`` whose state expires: its columns without ``events``, and ``session_start_ms``."""
    df = with_sessions(pings, idle_ms, cfg).withColumn("_vehicle", F.col("taxi_id"))
    df = trip_chain(df.withColumn("taxi_id", F.concat_ws("#", "taxi_id", "session_start_ms")), cfg)
    return df.withColumn("taxi_id", F.col("_vehicle")).drop("_vehicle", "events")
