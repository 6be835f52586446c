"""Geofence operators (T3–T7) as chunked running aggregates.

Each ping is processed in arrival order (``arrival_key, event_id``) per
vehicle, as the reference's keyed state sees it. Every value here is a running
maximum, sum or last value over the vehicle's earlier pings, computed within
chunks of the vehicle's pings plus a carry from the earlier chunks
(``plans/scan.py``), so a hot vehicle spreads over many tasks. The totals, the
gate and the status, which read each other, are in ``machine.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..functions.geo import haversine_sql
from ..plans.scan import Running, keyed_scan, row_chunks
from .parse import finite_positions

KEY = ["taxi_id"]
ORDER = ["arrival_key", "event_id"]


def late_filter(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """``accepted`` = ts at least the newest ts of all earlier pings.

    The newest *accepted* ts equals the newest ts of all earlier pings (a
    rejected ping is older than that maximum), so a running max suffices.
    """
    df = row_chunks(finite_positions(pings), KEY, "arrival_key", cfg.scan_chunk_rows)
    df = keyed_scan(df, KEY, ORDER, F.col("_chunk"),
                    [Running("prev_max_ts", "max", F.col("ts_ms"), inclusive=False)])
    return df.withColumn("accepted", F.col("prev_max_ts").isNull()
                         | (F.col("ts_ms") >= F.col("prev_max_ts")))


def fence_steps(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """T3–T7 for every ping; adds

    * ``accepted``        T3: not older than the newest ping seen before (ties kept)
    * ``d_center_km``     T4: distance from the centre
    * ``discarded``       T5: accepted and beyond 15 km (not forwarded)
    * ``forwarded``       accepted and within 15 km
    * ``area_violations`` T6: running count of discarded pings
    * ``area_event``      T7: ``warn`` / ``reset`` on crossing 10 km, forwarded pings only

    The second scan runs in the first one's chunks, so the pings keep their
    partitioning.
    """
    c = cfg
    df = late_filter(pings, cfg).withColumn("d_center_km", F.expr(
        haversine_sql(f"{c.center_lat!r}D", f"{c.center_lon!r}D", "latitude", "longitude", c)))
    df = df.withColumns({"discarded": F.expr(f"accepted AND d_center_km > {c.remove_radius_km!r}D"),
                         "forwarded": F.expr(f"accepted AND d_center_km <= {c.remove_radius_km!r}D"),
                         "_far": F.expr(f"d_center_km > {c.warn_radius_km!r}D")})
    df = keyed_scan(df, KEY, ORDER, F.col("_chunk"), [
        Running("area_violations", "sum", F.col("discarded").cast("long")),
        Running("_pfar", "last", F.when(F.col("forwarded"), F.col("_far")), inclusive=False)])
    event = ("CASE WHEN forwarded AND _far AND NOT coalesce(_pfar, false) THEN 'warn' "
             "WHEN forwarded AND NOT _far AND coalesce(_pfar, false) THEN 'reset' END")
    return df.withColumn("area_event", F.expr(event)).select(
        *pings.columns, "accepted", "d_center_km", "discarded", "forwarded", "area_violations", "area_event")
