"""Served current-state views (V1, V3–V12) over the per-ping outputs.

The reference keeps a hash per vehicle, sets per status and counters in a
key-value store; here each of these is a query over the outputs of
``machine.trip_chain`` and ``speed.speed_chain``. One partial aggregation per
vehicle (``max_by`` on the arrival order) yields the current state. Sums are
whole cents, so no partitioning changes a figure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lifecycle import MSG_SPEEDING

ORDER_COLS = ("arrival_key", "event_id")
STATUSES = ("active", "inactive", "halted", "removed")


# field groups of the stored vehicle row and the rows that write them
GROUPS = {
    # written by every accepted ping (status machine, stored total, flags)
    "last": ["status", "total_distance_km", "ten_km_crossed", "area_violations"],
    # written only by a stats row that passed the average gate
    "ok": ["last_update_ms", "latitude", "longitude"],
    # ... and the average only when it is positive (finite by construction)
    "avg": ["average_speed_kmph"],
    # written only by a speed output
    "speed": ["current_speed_kmph", "speeding", "speeding_speed_kmph"],
}


# source column of each stored field, and the pings that write each group
_SRC = {"status": "status", "total_distance_km": "stored_total", "ten_km_crossed": "warned",
        "area_violations": "area_violations", "last_update_ms": "ts_ms", "latitude": "latitude",
        "longitude": "longitude", "average_speed_kmph": "average_speed_kmph",
        "current_speed_kmph": "speed_kmph", "speeding": "is_speeding",
        # the speed of a speeding vehicle, nothing once its latest output isn't speeding
        "speeding_speed_kmph": "CASE WHEN is_speeding THEN speed_kmph END"}
_WRITES = {"last": None, "ok": "avg_reason = 'ok'", "avg": "avg_reason = 'ok' AND average_speed_kmph > 0",
           "speed": "speed_reason = 'ok'"}


TRIP_GROUPS, SPEED_GROUPS = ("last", "ok", "avg"), ("speed",)


def vehicle_state_partial(rows: DataFrame, groups: tuple[str, ...] = tuple(GROUPS)) -> DataFrame:
    """Per vehicle: each field group at its latest writing ping, with that
    ping's order (``<group>_order``) so partial states can be merged later, and
    the vehicle's share of the fleet counter in cents."""
    order = f"struct({', '.join(ORDER_COLS)})"
    aggs = []
    for g in groups:
        key = order if _WRITES[g] is None else f"CASE WHEN {_WRITES[g]} THEN {order} END"
        fields = ", ".join(f"'{c}', {_SRC[c]}" for c in GROUPS[g])
        aggs.append(F.expr(f"max_by(named_struct({fields}), {key})").alias(g))
        aggs.append(F.expr(f"max({key})").alias(f"{g}_order"))
    if "last" in groups:
        aggs.append(F.sum("fleet_delta_cents").alias("fleet_cents"))
    return rows.groupBy("taxi_id").agg(*aggs)


def merge_vehicle_state(parts: DataFrame) -> DataFrame:
    """Merge partial states (any number of rows per vehicle): each group from
    the row where it was written last; fleet contributions add up."""
    aggs = []
    for g in GROUPS:
        aggs.append(F.max_by(g, f"{g}_order").alias(g))
        aggs.append(F.max(f"{g}_order").alias(f"{g}_order"))
    return parts.groupBy("taxi_id").agg(*aggs, F.sum("fleet_cents").alias("fleet_cents"))


def flatten_state(parts: DataFrame) -> DataFrame:
    return parts.select("taxi_id", *[F.col(f"{g}.{c}").alias(c) for g, cols in GROUPS.items() for c in cols],
                        "fleet_cents")


def vehicle_state(trips: DataFrame, speeds: DataFrame) -> DataFrame:
    """V1 + V2 final state: one row per vehicle, as the store's hash holds it.

    Position, update time and average come from the latest stats row that
    passed the average gate; the stored total is the value after the last ping
    (it is also written and zeroed outside the gate); speed fields come from the
    latest speed output. Both inputs are aggregated before they meet.
    """
    t, s = vehicle_state_partial(trips, TRIP_GROUPS), vehicle_state_partial(speeds, SPEED_GROUPS)
    return flatten_state(t.join(s, "taxi_id", "left"))


def status_counts(state: DataFrame) -> DataFrame:
    """V3: vehicles per status (vehicles that never got a status are left out)."""
    return state.filter(F.col("status").isNotNull()).groupBy("status").agg(
        F.count("*").alias("vehicles"))


def status_members(state: DataFrame) -> DataFrame:
    """V4: the status sets as (status, taxi_id) rows."""
    return state.filter(F.col("status").isNotNull()).select("status", "taxi_id")


def violation_members(state: DataFrame) -> DataFrame:
    """V6: vehicles currently beyond 10 km and/or currently speeding."""
    return (state.select("taxi_id",
                         F.coalesce(F.col("ten_km_crossed"), F.lit(False)).alias("area_10km"),
                         F.coalesce(F.col("speeding"), F.lit(False)).alias("speeding"))
            .filter(F.col("area_10km") | F.col("speeding")))


def violation_counts(state: DataFrame) -> DataFrame:
    """V7: dashboard counts of speeding and area violations."""
    v = violation_members(state)
    return v.agg(F.count_if(F.col("speeding")).alias("speeding_vehicles"),
                 F.count_if(F.col("area_10km")).alias("area_violation_vehicles"))


def fleet_distance(trips: DataFrame) -> DataFrame:
    """V5: sum of the positive increments of every vehicle's stored total."""
    return trips.agg((F.coalesce(F.sum("fleet_delta_cents"), F.lit(0)) / 100.0).alias("total_distance_all_km"))


def event_log(trips: DataFrame, speeds: DataFrame) -> DataFrame:
    """V8: every logged message, one row each, numbered within its ping."""
    by_trip = trips.select("taxi_id", "event_id", "arrival_key", F.explode("events").alias("e")).select(
        "taxi_id", "event_id", "arrival_key", "e.pos", "e.kind", "e.message")
    head, _, tail = MSG_SPEEDING.replace("{id}", "{0}").partition("{0}")
    middle, _, end = tail.partition("{n}")
    by_speed = speeds.filter("is_speeding").select(
        "taxi_id", "event_id", "arrival_key", F.lit(99).alias("pos"), F.lit("speeding").alias("kind"),
        F.concat(F.lit(head), "taxi_id", F.lit(middle), F.col("speeding_no").cast("string"), F.lit(end)).alias("message"))
    # a ping has at most a handful of messages: these windows stay tiny
    sub = F.row_number().over(Window.partitionBy("taxi_id", "event_id", "arrival_key").orderBy("pos")) - 1
    return by_trip.unionByName(by_speed).withColumn("sub", sub).select(
        "taxi_id", "event_id", "arrival_key", "sub", "kind", "message")


def newest_first(events: DataFrame) -> DataFrame:
    """V8 as it is read: the latest message first."""
    return events.orderBy(F.desc("arrival_key"), F.desc("event_id"), F.desc("sub"))


def vehicles_in_bounds(state: DataFrame, lat_min: float, lon_min: float,
                       lat_max: float, lon_max: float) -> DataFrame:
    """V9: vehicles whose current position lies in the rectangle (inclusive)."""
    return state.filter(F.col("latitude").between(lat_min, lat_max)
                        & F.col("longitude").between(lon_min, lon_max))


def vehicle_lookup(state: DataFrame, taxi_id=None, status=None, violation=None) -> DataFrame:
    """Look up by id, by status, or by violation kind (``speeding``/``area_10km``)."""
    out = state
    if taxi_id is not None:
        out = out.filter(F.col("taxi_id") == F.lit(str(taxi_id)))
    if status is not None:
        out = out.filter(F.col("status") == status)
    if violation == "speeding":
        out = out.filter(F.coalesce(F.col("speeding"), F.lit(False)))
    elif violation == "area_10km":
        out = out.filter(F.coalesce(F.col("ten_km_crossed"), F.lit(False)))
    return out


def fleet_dashboard(state: DataFrame) -> DataFrame:
    """One row with the dashboard figures. A vehicle is currently driving
    if it is active and its latest speed output is above zero. The mean of the
    averages is a sum of whole hundredths."""
    hundredths = F.floor(F.col("average_speed_kmph") * 100 + 0.5).cast("long")
    return state.agg(
        *[F.count_if(F.col("status") == s).alias(s) for s in STATUSES],
        ((F.sum(hundredths) / F.count("average_speed_kmph")) / 100.0).alias("mean_average_speed_kmph"),
        F.count_if(F.coalesce(F.col("speeding"), F.lit(False))).alias("speeding_vehicles"),
        F.count_if(F.coalesce(F.col("ten_km_crossed"), F.lit(False))).alias("area_violation_vehicles"),
        F.count_if((F.col("status") == "active") & (F.col("current_speed_kmph") > 0)).alias("driving_vehicles"),
        (F.coalesce(F.sum("fleet_cents"), F.lit(0)) / 100.0).alias("total_distance_all_km"))


def remove_vehicles(state: DataFrame, ids: DataFrame) -> DataFrame:
    """The state without the given vehicles (left anti join on the id)."""
    return state.join(ids.select("taxi_id"), "taxi_id", "left_anti")
