"""Per-vehicle interval join of pings and speeds.

``speed.ts BETWEEN ping.ts - bound AND ping.ts + bound`` on the same vehicle.
An equi-join on the vehicle alone would compare every ping of a vehicle with
every speed of it (one task, quadratic for a hot vehicle). Instead time is cut
into buckets of ``bound``: each ping is matched against the speeds of its own
and the two neighbouring buckets by an equi-join on ``(taxi_id, bucket)``, and
the exact interval is checked after. Candidates per ping are bounded by the
ping density of three buckets, and the join keys spread a vehicle over many
tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.num import idiv


def interval_join(pings: DataFrame, speeds: DataFrame, bound_ms: int) -> DataFrame:
    """Inner join of ``pings`` (``taxi_id, ts_ms, ...``) with ``speeds``
    (``taxi_id, ts_ms, ...``) where ``|speed.ts - ping.ts| <= bound_ms``.
    Columns of ``speeds`` other than the key are prefixed with ``speed_``."""
    p = pings.withColumn("_b", idiv(F.col("ts_ms"), bound_ms))
    p = p.withColumn("_jb", F.explode(F.array(F.col("_b") - 1, F.col("_b"), F.col("_b") + 1)))
    s = speeds.select(F.col("taxi_id").alias("_tid"),
                      *[F.col(c).alias(f"speed_{c}") for c in speeds.columns if c != "taxi_id"])
    s = s.withColumn("_sb", idiv(F.col("speed_ts_ms"), bound_ms))
    j = p.join(s, (p["taxi_id"] == s["_tid"]) & (p["_jb"] == s["_sb"]))
    j = j.filter(F.col("speed_ts_ms").between(F.col("ts_ms") - bound_ms, F.col("ts_ms") + bound_ms))
    return j.drop("_b", "_jb", "_sb", "_tid")
