"""The event log by arrival range: newest messages against a plain sort, what is read, replays."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gpsweave.operators.log_ranges import append_log, first_range_of_newest, newest_messages, read_log

COLS = "taxi_id string, event_id long, arrival_key long, sub int, kind string, message string"


def _events(spark, n=2000):
    e = spark.range(n).select(F.pmod("id", F.lit(7)).cast("string").alias("taxi_id"), F.col("id").alias("event_id"),
                              (F.col("id") + F.when(F.pmod("id", F.lit(17)) == 0, 300).otherwise(0)).alias("arrival_key"),
                              F.explode(F.sequence(F.lit(0), F.pmod("id", F.lit(3)).cast("int"))).alias("sub"))
    return e.withColumn("kind", F.lit("k")).withColumn("message", F.concat_ws("-", "event_id", "sub"))


def _plain(events, n):
    keys = [(r.arrival_key, r.event_id, r.sub, r.message) for r in events.collect()]
    return sorted(keys, reverse=True)[:n]


@pytest.fixture(scope="module")
def log(spark):
    path = tempfile.mkdtemp(prefix="gw-log-") + "/log"
    events = _events(spark)
    for b in range(3):
        append_log(events.filter(F.pmod("event_id", F.lit(3)) == b), b, path, 100)
    return path, events


@pytest.mark.parametrize("n", [0, 1, 7, 150, 500, 100_000])
def test_newest_equals_a_plain_sort(spark, log, n):
    path, events = log
    got = [(r.arrival_key, r.event_id, r.sub, r.message) for r in newest_messages(spark, path, n).collect()]
    assert got == _plain(events, n)


def test_only_the_last_ranges_are_read(spark, log):
    path, events = log
    first = first_range_of_newest(spark, path, 150)
    keys = [k[0] for k in _plain(events, 150)]
    assert first == min(keys) // 100 > 15
    df = newest_messages(spark, path, 150)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan and "arrival_range" in plan.split("PartitionFilters")[1][:80]
    df.collect()
    scan = df._jdf.queryExecution().executedPlan()
    while scan.children().size():
        scan = scan.children().head()
    files = read_log(spark, path).select("_metadata.file_path", "arrival_range").distinct()
    assert scan.metrics().get("numFiles").get().value() == files.filter(F.col("arrival_range") >= first).count() < files.count() / 4


def test_a_replayed_batch_changes_nothing(spark, log):
    path, events = log
    append_log(events.filter("pmod(event_id, 3) = 1"), 1, path, 100)
    assert read_log(spark, path).count() == events.count()
    assert spark.read.parquet(f"{path}/manifest").agg(F.sum("messages")).first()[0] == events.count()


def test_messages_without_arrival_and_empty_batches(spark):
    path = tempfile.mkdtemp(prefix="gw-log-") + "/log"
    rows = [("1", 5, None, 0, "k", "oldest"), ("1", 6, 10, 0, "k", "a"), (None, None, 10, 0, None, None), ("1", 7, 250, 1, "k", "b")]
    append_log(spark.createDataFrame(rows, COLS), 0, path, 100)
    append_log(spark.createDataFrame([], COLS), 1, path, 100)
    assert [r.message for r in newest_messages(spark, path, 1).collect()] == ["b"]
    assert [r.message for r in newest_messages(spark, path, 9).collect()] == ["b", "a", None, "oldest"]


def test_the_live_sinks_keep_the_log_by_ranges(spark):
    from conftest import SF001
    from gpsweave.operators.lifecycle import lifecycle
    from gpsweave.sources import fixtures as FX
    from gpsweave.streaming.sinks import start_fresh, state_sinks
    root = tempfile.mkdtemp(prefix="gw-live-log-")
    out = lifecycle(FX.trips(spark, SF001))
    for _ in range(2):   # the second time is a replay
        state_sinks(root, log_width=256)(out, 0)
    want = out.select("taxi_id", "event_id", "arrival_key", F.explode("events").alias("e")).select("taxi_id", "event_id", "arrival_key", "e.*")
    got = read_log(spark, f"{root}/log").select(*want.columns)
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert [r.message for r in newest_messages(spark, f"{root}/log", 20).collect()] == [k[3] for k in _plain(want, 20)]
    start_fresh(spark, root)
    with pytest.raises(Exception):
        read_log(spark, f"{root}/log").count()


def test_a_batch_is_one_folder_of_ranges(spark):
    path = tempfile.mkdtemp(prefix="gw-log-") + "/log"
    events = _events(spark, 300)
    append_log(events, 4, path, 100)
    assert len(os.listdir(f"{path}/messages/batch_id=4")) > 3
    append_log(events.filter("event_id < 150"), 5, path, 100)
    append_log(events, 4, path, 100)   # a replay
    assert read_log(spark, path).count() == events.count() + events.filter("event_id < 150").count()
