"""Invariants of the pipeline outputs at sf0.01."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF01
from gpsweave.operators.machine import trip_chain
from gpsweave.operators.speed import speed_chain
from gpsweave.operators.trips import fence_steps
from gpsweave.operators.views import status_counts, vehicle_state
from gpsweave.sources.fixtures import trips


def test_status_counts_cover_every_vehicle_with_a_status(spark):
    pings = trips(spark, SF01)
    st = vehicle_state(trip_chain(pings), speed_chain(pings))
    counted = status_counts(st).agg(F.sum("vehicles")).first()[0]
    assert counted == st.filter(F.col("status").isNotNull()).count()
    assert st.count() == pings.select("taxi_id").distinct().count()


def test_totals_never_decrease_within_a_trip_and_accepted_time_never_decreases(spark):
    s = trip_chain(trips(spark, SF01)).filter("kind = 'forwarded'")
    w = Window.partitionBy("taxi_id", "trip_no").orderBy("arrival_key", "event_id")
    d = s.select((F.col("total_distance_km") - F.lag("total_distance_km").over(w)).alias("d"),
                 (F.col("total_time_s") - F.lag("total_time_s").over(w)).alias("t"))
    assert d.filter("d < 0 OR t < 0").count() == 0
    a = fence_steps(trips(spark, SF01)).filter("accepted")
    wa = Window.partitionBy("taxi_id").orderBy("arrival_key", "event_id")
    assert a.select((F.col("ts_ms") - F.lag("ts_ms").over(wa)).alias("dt")).filter("dt < 0").count() == 0


def test_fence_and_machine_agree(spark):
    t = trips(spark, SF01)
    m = trip_chain(t).select("event_id", "kind", F.col("area_event").alias("a1"), F.col("area_violations").alias("v1"))
    f = fence_steps(t).select("event_id", F.when(~F.col("accepted"), "late").when(F.col("discarded"), "discarded")
                              .otherwise("forwarded").alias("k2"), F.col("area_event").alias("a2"), F.col("area_violations").alias("v2"))
    j = m.join(f, "event_id")
    assert j.count() == 10000
    assert j.filter((F.col("kind") != F.col("k2")) | ~F.col("a1").eqNullSafe(F.col("a2")) | (F.col("v1") != F.col("v2"))).count() == 0
