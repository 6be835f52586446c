"""G3 with the reference's windows: a cell's window opens with its first record
and closes ``grid_window`` later; the next record at or after that opens the next.

Where a window opens depends on where the one before it did, so the starts are a
chain through a cell's record times. In batch the chain isn't walked: every
record time is linked to the time that would open the next window, and the times
reachable from the first one are found by pointer doubling (round k marks the
starts up to 2^k windows on, and doubles all links), so a cell with a million
windows takes twenty rounds of joins on (cell, time). Links and the window of
each record come from chunked scans (``plans/scan.py``), so no cell has to fit
into one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..plans.scan import Running, keyed_scan, row_chunks
from ..session import scratch_path
from .grid import with_grid_id

_AT = ["grid_id", "us"]


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _length_us(cfg: FleetConfig) -> int:
    number, unit = cfg.grid_window.split()
    return int(float(number) * 1_000_000 * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")])


def _links(times: DataFrame, length: int, cfg: FleetConfig) -> DataFrame:
    """Each record time of a cell (us) and the first one at least ``length`` later (to)."""
    marks = times.select("grid_id", F.explode(F.array(
        F.struct((-F.col("us")).alias("back"), F.lit(0).alias("asks"), F.lit(None).cast("long").alias("of")),
        F.struct((-F.col("us") - length).alias("back"), F.lit(1).alias("asks"), F.col("us").alias("of")))).alias("m")).select("grid_id", "m.*")
    # from the latest time backwards: the last record seen is the next one in time
    marks = row_chunks(_written(marks, "grid-marks"), ["grid_id"], "back", cfg.scan_chunk_rows)
    found = keyed_scan(marks, ["grid_id"], ["back", "asks"], F.col("_chunk"),
                       [Running("_next", "last", F.when(F.col("asks") == 0, -F.col("back")))])
    return found.filter("asks = 1 AND _next IS NOT NULL").select("grid_id", F.col("of").alias("us"), F.col("_next").alias("to"))


def window_starts(times: DataFrame, length: int, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """grid_id and us of every window's start, from the distinct record times of the cells."""
    links = _written(_links(times, length, cfg), "grid-links")
    starts = _written(times.groupBy("grid_id").agg(F.min("us").alias("us")), "grid-starts")
    while not links.isEmpty():
        on = starts.join(links, _AT).select("grid_id", F.col("to").alias("us"))
        starts = _written(starts.unionByName(on), "grid-starts")
        far = links.select("grid_id", F.col("us").alias("to"), F.col("to").alias("far"))
        links = _written(links.join(far, ["grid_id", "to"]).select("grid_id", "us", F.col("far").alias("to")), "grid-links")
    return starts


def grid_window_first_record(speeds: DataFrame, cfg: FleetConfig = DEFAULT, ts_col: str = "ts",
                             tiebreak: str = "event_id") -> DataFrame:
    """grid_id, window_start_us, window_end_us, avg_speed_kmph and vehicles of
    every window: the mean of each vehicle's latest speed in it. Rows without a
    time or a position have no window; an empty table gives no rows."""
    length = _length_us(cfg)
    rows = with_grid_id(speeds, cfg).select("grid_id", "taxi_id", "speed_kmph", F.unix_micros(F.col(ts_col).cast("timestamp")).alias("us"),
                                            F.col(tiebreak).alias("tie"))
    rows = _written(rows.filter("grid_id IS NOT NULL AND us IS NOT NULL"), "grid-rows")
    starts = window_starts(_written(rows.select(*_AT).distinct(), "grid-times"), length, cfg)
    both = rows.withColumn("opens", F.lit(1)).unionByName(
        starts.withColumn("opens", F.lit(0)), allowMissingColumns=True)
    both = row_chunks(_written(both, "grid-both"), ["grid_id"], "us", cfg.scan_chunk_rows)
    placed = keyed_scan(both, ["grid_id"], ["us", "opens", "tie"], F.col("_chunk"),
                        [Running("start", "last", F.when(F.col("opens") == 0, F.col("us")))]).filter("opens = 1")
    latest = placed.groupBy("grid_id", "start", "taxi_id").agg(F.max_by("speed_kmph", F.struct("us", "tie")).alias("speed_kmph"))
    micro = F.floor(F.col("speed_kmph") * 1e6 + 0.5)      # an exact sum, as in grid_window
    cells = latest.groupBy("grid_id", "start").agg(F.sum(micro).alias("_sum_micro"), F.count("*").alias("vehicles"))
    return cells.select("grid_id", F.col("start").alias("window_start_us"), (F.col("start") + length).alias("window_end_us"),
                        ((F.col("_sum_micro") / F.col("vehicles")) / 1e6).alias("avg_speed_kmph"), "vehicles")
