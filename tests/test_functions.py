"""Shared functions: rounding as the reference does it, the bucketed interval
join, alert texts."""

import math

from pyspark.sql import functions as F

from conftest import SF001
from gpsweave.functions.geo import round_half_up
from gpsweave.operators.joins import interval_join
from gpsweave.operators.lifecycle import lifecycle
from gpsweave.operators.speed import speed_chain
from gpsweave.sources.fixtures import trips


def test_java_style_rounding(spark):
    df = spark.createDataFrame([(2.675,), (1.005,), (-1.5,), (0.125,)], "x double")
    got = [r.r for r in df.select(round_half_up(F.col("x"), 2).alias("r")).collect()]
    # floor(x * 100 + 0.5) / 100 on the double value, as Math.round does
    assert got == [math.floor(x * 100 + 0.5) / 100 for x in (2.675, 1.005, -1.5, 0.125)]


def test_bucketed_join_equals_the_plain_condition(spark):
    pings = speed_chain(trips(spark, SF001)).select("taxi_id", "event_id", "ts_ms")
    speeds = speed_chain(trips(spark, SF001)).filter("speed_reason = 'ok'").select(
        "taxi_id", "event_id", "ts_ms", F.col("speed_kmph").alias("kmph"))
    bound = 30 * 60 * 1000
    s = speeds.select(F.col("taxi_id").alias("t"), F.col("event_id").alias("speed_event_id"), F.col("ts_ms").alias("at"),
                      F.col("kmph").alias("speed_kmph"))
    a = pings.join(s, (F.col("taxi_id") == F.col("t")) & (F.abs(F.col("at") - F.col("ts_ms")) <= bound)).select(
        "event_id", "speed_event_id", "speed_kmph")
    b = interval_join(pings, speeds, bound).select("event_id", "speed_event_id", "speed_kmph")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_alert_projection_and_console_sink_builder(spark):
    from gpsweave.streaming.live import alert_stream
    from gpsweave.streaming.sinks import console_sink
    lc = lifecycle(trips(spark, SF001))
    alerts = alert_stream(lc)
    n = lc.filter("is_speeding").count()
    assert alerts.count() == n > 0
    assert alerts.first().alert.startswith("Speeding Alert! TaxiID=")
    live = spark.readStream.format("rate").load().selectExpr("CAST(value AS STRING) AS line")
    assert console_sink(live) is not None      # builder only; nothing is started
