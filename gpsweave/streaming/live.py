"""Live pipeline: message stream -> parsed pings -> state machine -> sinks.

``readStream`` of message text (Kafka, or files of the same ``message`` column)
→ S2 parse → T1 watermark on event time → per-vehicle state machine
(``transformWithStateInPandas``) → per-ping outputs. Grid windows (G3) chain
on the speed outputs as event-time aggregations in append mode. Outputs are
written by ``foreachBatch`` sinks (``sinks.py``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT, FleetConfig
from ..functions.num import idiv
from ..operators.grid import grid_window
from ..operators.lifecycle import IN_COLS, OUT_SCHEMA, with_center_distance
from ..operators.parse import parse_pings
from ..operators.speed import alert_text
from .processor import BUCKETS, VehicleProcessor

# a file-stream message record: arrival position, tiebreak and the wire text
MESSAGE_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("arrival_key", T.LongType()),
    T.StructField("message", T.StringType()),
])


def file_messages(spark: SparkSession, path: str, fmt: str = "parquet",
                  max_files_per_trigger: int | None = None) -> DataFrame:
    """S1 (file form): message records appearing as files under ``path``."""
    r = spark.readStream.schema(MESSAGE_SCHEMA).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_messages(spark: SparkSession, servers: str, topic: str = "taxi-location",
                   max_offsets_per_trigger: int = 1_000_000) -> DataFrame:
    """The topic from the earliest offset (full replay on each fresh start).

    Needs the Kafka connector on the classpath. Offsets repeat across
    partitions, so the arrival key is the broker's time and the id is made of
    partition and offset: together they order all records and tell them apart.
    ``max_offsets_per_trigger`` bounds a micro-batch, the first one too.
    """
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", "earliest")
         .option("maxOffsetsPerTrigger", max_offsets_per_trigger))
    return message_records(r.load())


def message_records(records: DataFrame) -> DataFrame:
    """Kafka records as message records (``MESSAGE_SCHEMA``)."""
    return records.select(
        (F.col("partition").cast("long") * (1 << 44) + F.col("offset")).alias("event_id"),
        F.unix_micros("timestamp").alias("arrival_key"), F.col("value").cast("string").alias("message"))


def vehicle_stream(messages: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Per-ping outputs of the state machine (``OUT_SCHEMA``) with their event time, streaming."""
    pings = parse_pings(messages, keep=["event_id", "arrival_key"])
    pings = with_center_distance(pings, cfg).select(*IN_COLS)
    pings = (pings.withColumn("event_time", F.timestamp_millis("ts_ms"))
             .withWatermark("event_time", cfg.watermark))
    # Late pings are part of the machine's own semantics (T3 keeps and judges
    # them), so the stateful operator does not re-stamp event time: outputs may
    # be older than the watermark. Event-time consumers read the written output
    # as a second stream with their own watermark (``grid_stream``).
    bucketed = pings.withColumn("bucket", F.pmod(F.xxhash64("taxi_id"), F.lit(BUCKETS)))
    out = bucketed.groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=VehicleProcessor(cfg), outputStructType=OUT_SCHEMA, outputMode="Append", timeMode="None")
    return out.withColumn("event_time", F.timestamp_millis("ts_ms"))


def grid_stream(vehicle_out: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """G3 on the live speed outputs (a stream over the written per-ping table):
    closed windows are emitted once the watermark passes their end (append)."""
    speeds = (vehicle_out.filter(F.col("speed_reason") == "ok")
              .withWatermark("event_time", cfg.watermark))
    return grid_window(speeds, cfg, ts_col="event_time", tiebreak="event_id")


def alert_stream(vehicle_out: DataFrame) -> DataFrame:
    """Speeding alert texts."""
    return vehicle_out.filter(F.col("is_speeding")).select("taxi_id", "ts_ms", alert_text().alias("alert"))


def location_speed_join_stream(pings_out: DataFrame, speeds_out: DataFrame, bound_ms: int = 5000,
                               watermark: str = "10 seconds") -> DataFrame:
    """T25 live: forwarded pings joined with the same vehicle's speed outputs
    within ``bound_ms`` of event time. A time bucket is part of the key, so a
    ping meets only its vehicle's speeds of three buckets, and a hot vehicle
    spreads over its buckets; both sides are watermarked, so state is dropped
    once it can no longer match.

    Both inputs are streams over the written per-ping table (two reads of it).
    """
    bucket = idiv(F.col("ts_ms"), bound_ms)
    p = (pings_out.filter(F.col("kind") == "forwarded")
         .select("taxi_id", "event_id", "ts_ms", "latitude", "longitude", "end_flag", "event_time",
                 F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("bucket"))
         .withWatermark("event_time", watermark))
    s = (speeds_out.filter(F.col("speed_reason") == "ok")
         .select(F.col("taxi_id").alias("s_taxi_id"), F.col("event_id").alias("speed_event_id"),
                 F.col("event_time").alias("s_time"), F.col("speed_kmph"), F.col("is_speeding").alias("speed_is_speeding"),
                 bucket.alias("s_bucket"))
         .withWatermark("s_time", watermark))
    cond = F.expr(f"taxi_id = s_taxi_id AND bucket = s_bucket AND s_time BETWEEN event_time - INTERVAL {bound_ms} MILLISECONDS "
                  f"AND event_time + INTERVAL {bound_ms} MILLISECONDS")
    return p.join(s, cond).drop("s_taxi_id", "s_time", "bucket", "s_bucket")


def finish(writer) -> None:
    """Start a query over all that is available and wait until it is done, for
    as long as that takes; an error of the query is raised here."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def replay_vehicle_stream(messages: DataFrame, root: str, steps: int, cfg: FleetConfig = DEFAULT,
                          stream=None, sinks=None) -> None:
    """Let message records arrive in ``steps`` parts by arrival position, and run
    the live vehicle path (or ``stream`` of the messages into ``sinks``) after
    each: every run goes on from the checkpoint of the one before. All messages in
    ``root/sent``, those arrived in ``root/in``, outputs in ``root/out``."""
    from .sinks import state_sinks
    stream, sinks = stream or (lambda m: vehicle_stream(m, cfg)), sinks or state_sinks
    spark = messages.sparkSession
    messages.select(*MESSAGE_SCHEMA.names).write.parquet(f"{root}/sent")   # made once, read by every part
    messages = spark.read.schema(MESSAGE_SCHEMA).parquet(f"{root}/sent")
    last = messages.agg(F.max("arrival_key")).first()[0]
    span = ((last or 0) + steps) // steps
    for i in range(steps):
        (messages.filter(idiv(F.col("arrival_key"), span) == i).write.mode("append").parquet(f"{root}/in"))
        out = stream(file_messages(spark, f"{root}/in"))
        finish(out.writeStream.foreachBatch(sinks(f"{root}/out")).option("checkpointLocation", f"{root}/checkpoint"))
