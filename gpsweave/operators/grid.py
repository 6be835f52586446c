"""Traffic grid (G1–G7): per-cell density and speed in time windows.

The reference fires a processing-time timer 10 s after a cell's first record
and averages the *latest* speed of each vehicle seen in the cell. Here the
window is an event-time tumbling window (deterministic, replayable, and the
same operator in batch and stream): latest speed per (window, cell, vehicle),
then mean and count per (window, cell). Both steps are hash aggregates with
map-side partial aggregation, so a hot cell or vehicle is combined before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..functions.geo import grid_bounds, grid_id
from ..plans.scan import Running, keyed_scan, row_chunks

# --- fixed values: traffic status rule of the reference, in order ---
# (status, mean speed below, vehicles at least); else FREE_FLOW
STATUS_RULES = [("CONGESTED", 5.0, 3), ("MODERATE", 15.0, 3), ("MODERATE", 10.0, 2)]


def with_grid_id(df: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """G1: ``grid_id`` = ``<lat index>_<lon index>`` (indices truncate toward 0)."""
    return df.withColumn("grid_id", grid_id(F.col("latitude"), F.col("longitude"), cfg))


def with_grid_bounds(df: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Corners of the cell named in ``grid_id``."""
    for name, col in grid_bounds(F.col("grid_id"), cfg).items():
        df = df.withColumn(name, col)
    return df


def traffic_status(avg_speed, vehicles):
    """CONGESTED / MODERATE / FREE_FLOW from mean speed and vehicle count."""
    out = F.lit("FREE_FLOW")
    for name, below, least in reversed(STATUS_RULES):
        out = F.when((avg_speed < below) & (vehicles >= least), F.lit(name)).otherwise(out)
    return out


def grid_window(speeds: DataFrame, cfg: FleetConfig = DEFAULT, ts_col: str = "ts",
                tiebreak: str = "event_id") -> DataFrame:
    """Per (window, cell): mean of each vehicle's latest speed, vehicle count.

    ``speeds`` has ``taxi_id, latitude, longitude, speed_kmph`` and an event
    time column. Works on streaming DataFrames too (with a watermark).
    """
    df = with_grid_id(speeds, cfg)
    win = F.window(F.col(ts_col), cfg.grid_window)
    latest = (df.groupBy(win.alias("window"), "grid_id", "taxi_id")
              .agg(F.max_by("speed_kmph", F.struct(F.col(ts_col), F.col(tiebreak))).alias("speed_kmph")))
    # the mean is accumulated in whole micro-km/h: an exact integer sum, so the
    # result does not depend on the order in which partial sums are combined
    micro = F.floor(F.col("speed_kmph") * 1e6 + 0.5)
    cells = (latest.groupBy("window", "grid_id")
             .agg(F.sum(micro).alias("_sum_micro"), F.count("*").alias("vehicles")))
    return cells.select("window", "grid_id",
                        ((F.col("_sum_micro") / F.col("vehicles")) / 1e6).alias("avg_speed_kmph"), "vehicles")


def grid_snapshot(cells: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """The stored cell row: bounds, mean speed (number and 2-decimal text),
    vehicle count, status, update time (window end)."""
    df = with_grid_bounds(cells, cfg)
    return df.select(
        "grid_id", "bottom_left_lat", "bottom_left_lon", "top_right_lat", "top_right_lon",
        "avg_speed_kmph", F.format_string("%.2f", F.col("avg_speed_kmph")).alias("avg_speed_text"),
        "vehicles", traffic_status(F.col("avg_speed_kmph"), F.col("vehicles")).alias("traffic_status"),
        F.col("window.end").alias("updated_at"))


def recent_grids(snapshots: DataFrame, k: int | None = None) -> DataFrame:
    """The latest snapshot of every cell, most recently updated first (the
    first ``k`` of them if asked for)."""
    latest = snapshots.groupBy("grid_id").agg(
        F.max_by(F.struct(*[c for c in snapshots.columns if c != "grid_id"]), F.col("updated_at")).alias("s"))
    out = latest.select("grid_id", "s.*").orderBy(F.col("updated_at").desc(), "grid_id")
    return out if k is None else out.limit(k)


def grid_moves(speed_rows: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Speed outputs whose cell differs from the vehicle's previous output.
    ``speed_rows`` is a written table: the scan reads it for the chunk carries
    and for the rows."""
    df = row_chunks(speed_rows, ["taxi_id"], "arrival_key", cfg.scan_chunk_rows)
    df = keyed_scan(df, ["taxi_id"], ["arrival_key", "event_id"], F.col("_chunk"),
                    [Running("prev_grid_id", "last", F.col("grid_id"), inclusive=False)])
    return df.filter(F.col("prev_grid_id").isNotNull() & (F.col("prev_grid_id") != F.col("grid_id"))).drop("_chunk")
