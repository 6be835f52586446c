"""File sources and sinks: raw files (empty, blank lines, arity), prepared CSV,
metric JSON, ordered CSV sink, versioned upsert sink."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from gpsweave.operators import prep as Q
from gpsweave.sources import files as S
from gpsweave.streaming.sinks import append_batch


@pytest.fixture()
def raw_dir():
    d = tempfile.mkdtemp(prefix="gw-raw-")
    with open(f"{d}/1.txt", "w") as f:
        f.write("1,2008-02-02 15:36:08,116.51172,39.92123\n1,2008-02-02 15:46:08,116.51135,39.93883\n\n")
    with open(f"{d}/2.txt", "w") as f:
        f.write("2,2008-02-02 13:33:52,116.36422,39.88781\n2,2008-02-02 13:37:16,116.37481,39.88782\n"
                "2,2008-02-02 13:30:00,116.37,39.89\n2,not a date,116.4,39.9\n2,2008-02-02 14:00:00,200.0,39.9\n")
    open(f"{d}/3.txt", "w").close()                     # empty file
    with open(f"{d}/notes.md", "w") as f:
        f.write("ignored\n")
    return d


def test_raw_scan_skips_empty_and_other_files(spark, raw_dir):
    df = S.raw_csv_scan(spark, raw_dir)
    assert df.count() == 7
    assert {r.file_name for r in df.select("file_name").distinct().collect()} == {"1.txt", "2.txt"}
    assert S.raw_arity(spark, raw_dir).first().max_fields == 4


def test_raw_arity_detects_extra_column(spark, raw_dir):
    with open(f"{raw_dir}/4.txt", "w") as f:
        f.write("4,2008-02-02 13:33:52,116.36422,39.88781,extra\n")
    assert S.raw_arity(spark, raw_dir).first().max_fields == 5
    with pytest.raises(ValueError):
        Q.positional(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"))


def test_file_profile_counts_empty_files(spark, raw_dir):
    lines = S.file_text_lines(spark, raw_dir)
    files = S.file_listing(spark, raw_dir).select("file_name")
    prof = Q.file_line_profile(lines, files).first()
    assert (prof.total_files, prof.total_lines, prof.max_lines, prof.min_lines, prof.files_at_min,
            prof.empty_files) == (3, 7, 5, 2, 1, 1)
    assert prof.avg_lines == pytest.approx(7 / 3)


def test_prepare_pipeline_and_ordered_csv_roundtrip(spark, raw_dir):
    raw = S.raw_csv_scan(spark, raw_dir).withColumn("arrival_key", F.monotonically_increasing_id()) \
        .withColumn("event_id", F.col("arrival_key"))
    prepared = Q.prepare(raw)
    rows = prepared.orderBy("taxi_id", "ts").collect()
    assert len(rows) == 5                                 # bad date and off-map row removed
    assert [r.end_flag for r in rows if r.taxi_id == "2"] == [0, 0, 1]
    out = tempfile.mkdtemp(prefix="gw-csv-") + "/prepared"
    S.csv_sink(prepared.select("taxi_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"),
                               "longitude", "latitude", "end_flag"), out, ["date_time", "taxi_id"])
    back = S.prepared_csv_scan(spark, out)
    assert back.count() == 5
    parts = sorted(p for p in os.listdir(out) if p.startswith("part-"))
    times = [line.split(",")[1] for p in parts for line in open(f"{out}/{p}").read().splitlines()[1:]]
    assert times == sorted(times)


def test_metrics_json_scan(spark):
    d = tempfile.mkdtemp(prefix="gw-json-")
    with open(f"{d}/m.log", "w") as f:
        f.write('{"operator_name": "x", "timestamp": "2025-01-01T00:00:05.123Z", "latency_ms": 1.5, '
                '"throughput": 2.0, "cpu": 3.0, "mem_usage": 4.0}\n')
        f.write('{"timestamp": "2025-01-01T00:00:10.123456Z", "cpu": 1.0, "mem_usage": 2.0, '
                '"endpoints": {"/a": {"request_count": 3, "404": 1}}}\n')
    df = S.metrics_json_scan(spark, d).orderBy("ts").collect()
    assert df[0].ts.microsecond == 123000 and df[1].ts.microsecond == 123456
    assert df[1].endpoints["/a"]["404"] == 1.0 and df[0].cache_hit_ratio is None


def test_vehicle_state_is_merged_on_read_and_idempotent(spark):
    from gpsweave.operators.views import GROUPS, vehicle_state_partial
    from gpsweave.streaming.sinks import compact_vehicle_state, read_vehicle_state
    cols = ("taxi_id string, event_id long, arrival_key long, ts_ms long, latitude double, longitude double, status string, "
            "stored_total double, warned boolean, area_violations long, avg_reason string, average_speed_kmph double, "
            "speed_reason string, speed_kmph double, is_speeding boolean, fleet_delta_cents long")
    row = lambda v, i, status, cents: (v, i, i, i, 39.9, 116.4, status, cents / 100, False, 0, "ok", 10.0 + i, "ok", 60.0, i % 2 == 0, cents)
    root = tempfile.mkdtemp(prefix="gw-state-")
    for n, rows in enumerate([[row("1", 1, "active", 100), row("1", 2, "halted", 50), row("2", 3, "active", 7)],
                              [row("2", 4, "removed", 3)], [row("2", 4, "removed", 3)]]):
        append_batch(vehicle_state_partial(spark.createDataFrame(rows, cols)), min(n, 1), f"{root}/state")   # batch 1 is replayed
    got = {r.taxi_id: (r.status, r.fleet_cents, r.speeding_speed_kmph) for r in read_vehicle_state(spark, root).collect()}
    assert got == {"1": ("halted", 150, 60.0), "2": ("removed", 10, 60.0)}
    compact_vehicle_state(spark, root, f"{root}/small/state")
    small = spark.read.parquet(f"{root}/small/state")
    assert small.count() == 2 and set(GROUPS) <= set(small.columns)
    assert {r.taxi_id: r.status for r in read_vehicle_state(spark, f"{root}/small").collect()} == {"1": "halted", "2": "removed"}


def test_end_flag_keeps_rows_without_an_id(spark):
    rows = [(None, "2008-02-02 15:36:08", 116.5, 39.9), ("7", "2008-02-02 15:36:08", 116.5, 39.9), ("7", "2008-02-02 15:37:08", 116.5, 39.9)]
    raw = spark.createDataFrame([(*r, i, i) for i, r in enumerate(rows)],
                                "taxi_id string, date_time string, longitude double, latitude double, arrival_key long, event_id long")
    assert [(r.taxi_id, r.end_flag) for r in Q.prepare(raw).orderBy("event_id").collect()] == [(None, 0), ("7", 0), ("7", 1)]


def test_file_report_names_empty_and_unreadable_files(spark, raw_dir):
    with open(f"{raw_dir}/broken.txt.gz", "wb") as f:
        f.write(b"this is no gzip stream, though its name says so")
    got = {r.file_name: (r.state, r.lines) for r in S.file_report(spark, raw_dir, glob="*.{txt,gz}").collect()}
    assert got == {"1.txt": ("read", 3), "2.txt": ("read", 5), "3.txt": ("empty", 0), "broken.txt.gz": ("unreadable", 0)}


def test_kafka_records_keep_a_total_order_across_partitions(spark):
    from gpsweave.streaming.live import message_records
    rec = spark.createDataFrame([(0, 5, "2024-01-01 00:00:02", "b"), (1, 5, "2024-01-01 00:00:01", "a"), (2, 5, "2024-01-01 00:00:02", "c")],
                                "partition int, offset long, t string, v string")
    out = message_records(rec.select("partition", "offset", F.to_timestamp("t").alias("timestamp"), F.col("v").cast("binary").alias("value")))
    assert [r.message for r in out.orderBy("arrival_key", "event_id").collect()] == ["a", "b", "c"]
    assert out.select("event_id").distinct().count() == 3


def test_append_batch_replay_overwrites_its_partition(spark):
    path = tempfile.mkdtemp(prefix="gw-append-") + "/events"
    df = spark.createDataFrame([("a",), ("b",)], "m string")
    append_batch(df, 0, path)
    append_batch(df, 1, path)
    append_batch(df, 1, path)
    assert spark.read.parquet(path).count() == 4


def test_start_fresh_clears_sink_tables(spark):
    from gpsweave.streaming.sinks import start_fresh
    root = tempfile.mkdtemp(prefix="gw-fresh-")
    df = spark.createDataFrame([("a",)], "m string")
    append_batch(df, 0, f"{root}/events")
    append_batch(df, 0, f"{root}/state")
    start_fresh(spark, root)
    assert not os.path.exists(f"{root}/events") and not os.path.exists(f"{root}/state")


def test_profile_when_every_file_is_empty(spark):
    d = tempfile.mkdtemp(prefix="gw-empty-")
    for i in range(3):
        open(f"{d}/{i}.txt", "w").close()
    prof = Q.file_line_profile(S.file_text_lines(spark, d), S.file_listing(spark, d).select("file_name")).first()
    assert (prof.total_files, prof.total_lines, prof.max_lines, prof.min_lines, prof.empty_files) == (3, 0, 0, 0, 3)
    assert prof.avg_lines == 0.0


def test_message_sink_file_fallback_roundtrip(spark):
    from conftest import SF001
    from gpsweave.operators.parse import parse_pings
    from gpsweave.sources import fixtures as FX
    trips = FX.trips(spark, SF001)
    msgs = FX.messages(trips).join(trips.select("event_id", "taxi_id"), "event_id")
    path = tempfile.mkdtemp(prefix="gw-msg-") + "/topic"
    S.message_sink(msgs, path=path)
    back = spark.read.text(path).withColumnRenamed("value", "message")
    a = parse_pings(back).select("taxi_id", "ts_ms", "latitude", "longitude", "end_flag")
    b = parse_pings(msgs).select("taxi_id", "ts_ms", "latitude", "longitude", "end_flag")
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_many_folders_are_listed_by_a_few_hundred_tasks(spark):
    d = tempfile.mkdtemp(prefix="gw-many-")
    for i in range(400):
        os.mkdir(f"{d}/vehicle={i}")
        with open(f"{d}/vehicle={i}/part.csv", "w") as f:
            f.write(f"{i},2008-02-02 15:36:08,116.5,39.9\n")
    sc = spark.sparkContext
    sc.setJobGroup("many-folders", "listing")
    df = S.raw_csv_scan(spark, d, glob="*.csv", recursive=True)
    sc.setLocalProperty("spark.jobGroup.id", None)
    status = sc.statusTracker()
    tasks = [status.getStageInfo(s).numTasks for j in status.getJobIdsForGroup("many-folders") for s in status.getJobInfo(j).stageIds]
    assert tasks and max(tasks) <= 256
    assert {r.taxi_id for r in df.collect()} == {str(i) for i in range(400)}


def test_file_listing_of_folders_has_names_and_sizes(spark):
    d = tempfile.mkdtemp(prefix="gw-list-")
    os.makedirs(f"{d}/vehicle=1/old.txt")               # a folder of that name is no file
    for name, text in (("a b.txt", "1\n"), ("none.txt", ""), ("x.md", "2"), (",file.txt", "345"), ("_hidden%20.txt", "67")):
        with open(f"{d}/vehicle=1/{name}", "w") as f:
            f.write(text)
    rows = sorted(tuple(r) for r in S.file_listing(spark, f"{d}/*").collect())
    assert [(n, k, at.endswith(f"vehicle=1/{n}")) for n, k, at in rows] == [(",file.txt", 3, True), ("_hidden%20.txt", 2, True),
                                                                            ("a b.txt", 2, True), ("none.txt", 0, True)]


def test_listing_many_files_needs_few_calls(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="gw-calls-")
    for i in range(300):
        with open(f"{d}/{i}.txt", "w") as f:
            f.write("1\n")
    client, calls = type(spark.sparkContext._gateway._gateway_client), []
    send = client.send_command
    monkeypatch.setattr(client, "send_command", lambda self, *a, **k: calls.append(1) or send(self, *a, **k))
    assert S.file_listing(spark, d).count() == 300 and len(calls) < 300


def _files(root, spoil=lambda text: sorted(text.split("\n"))):
    """The lines of every vehicle's folder, and the names of its files."""
    found = {d: os.listdir(f"{root}/{d}") for d in os.listdir(root) if d.startswith("vehicle=")}
    return {d: spoil("".join(open(f"{root}/{d}/{f}").read() for f in names if f.startswith("part-"))) for d, names in found.items()}, found


ODD_IDS = ["7", None, "", "a/b", "50%", "x y", 'q"{[]}', "a=b:c*?#^\\'", "tab\tid"]


def test_raw_files_are_one_per_vehicle_and_as_sparks_writer_makes_them(spark):
    rows = [(v, t, x, y) for v in ODD_IDS for t, x, y in (("2008-02-02 15:36:08", 116.5, 39.9), (None, None, None), (' "a", b ', 1e-9, -0.0),
                                                         ("two\nlines", 1e20, 5.0), ("", float("nan"), 1.0))]
    df = spark.createDataFrame(rows, S.RAW_SCHEMA)
    root = tempfile.mkdtemp(prefix="gw-sink-")
    S.raw_files_sink(df.filter("taxi_id = '7'"), f"file://{root}/new")
    S.raw_files_sink(df, f"file://{root}/new")                                # takes the place of what was there
    df.withColumn("vehicle", F.col("taxi_id")).coalesce(1).write.partitionBy("vehicle").csv(f"{root}/spark")
    lines, names = _files(f"{root}/new")
    assert lines == _files(f"{root}/spark")[0] and len(lines) == 8
    assert all(len(n) == 1 and n[0].endswith(".csv") for n in names.values()), names      # no checksum files beside them
    assert sorted(os.listdir(root)) == ["new", "spark"] and "_SUCCESS" in os.listdir(f"{root}/new")
    assert S.raw_csv_scan(spark, f"{root}/new", glob="*.csv", recursive=True).count() == \
        S.raw_csv_scan(spark, f"{root}/spark", glob="*.csv", recursive=True).count()


def test_line_files_are_one_per_vehicle_and_as_sparks_writer_makes_them(spark):
    df = spark.createDataFrame([(v, t) for v in ODD_IDS for t in ("1,2", None, "  ", "", "\u00e9")], "vehicle string, value string")
    root = tempfile.mkdtemp(prefix="gw-sink-")
    S.line_files_sink(df, f"{root}/new")
    df.coalesce(1).write.partitionBy("vehicle").text(f"{root}/spark")
    lines, names = _files(f"{root}/new")
    assert lines == _files(f"{root}/spark")[0] and len(lines) == 8
    assert all(len(n) == 1 and n[0].endswith(".txt") for n in names.values()), names
    with pytest.raises(FileExistsError):
        S.line_files_sink(df, f"{root}/new")
    S.line_files_sink(df.filter("false"), f"{root}/none")
    assert os.listdir(f"{root}/none") == ["_SUCCESS"]


def test_a_vehicle_in_several_tasks_has_several_files(spark):
    df = spark.range(0, 40000, 1, 8).select(F.lit("1").alias("vehicle"), F.concat(F.lit("line "), "id").alias("value"))
    root, key = tempfile.mkdtemp(prefix="gw-hot-"), "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "16k")
    try:
        S.line_files_sink(df, f"{root}/new")
    finally:
        spark.conf.unset(key)
    lines, names = _files(f"{root}/new", spoil=str.split)
    assert len(names["vehicle=1"]) > 1 and len(lines["vehicle=1"]) == 80000 and len(set(lines["vehicle=1"])) == 40001


def test_a_failed_task_leaves_the_old_files(spark):
    root = tempfile.mkdtemp(prefix="gw-fail-")
    good = spark.createDataFrame([("1", "2008-02-02 15:36:08", 116.5, 39.9)], S.RAW_SCHEMA)
    S.raw_files_sink(good, f"{root}/new")
    with pytest.raises(Exception, match="no such ping"):
        S.raw_files_sink(good.withColumn("date_time", F.raise_error(F.lit("no such ping"))), f"{root}/new")
    assert os.listdir(root) == ["new"] and S.raw_csv_scan(spark, f"{root}/new", glob="*.csv", recursive=True).count() == 1


def test_arity_of_folders_is_read_without_a_column_for_each_folder_name(spark):
    d = tempfile.mkdtemp(prefix="gw-arity-")
    for v, text in (("vehicle=1", "1,a,2,3\n\n"), ("vehicle=2/old", "2,a,2,3,4\n")):     # two depths: no columns fit these names
        os.makedirs(f"{d}/{v}")
        with open(f"{d}/{v}/part.csv", "w") as f:
            f.write(text)
    assert S.raw_arity(spark, d, glob="*.csv", recursive=True).first().max_fields == 5


def test_folders_of_other_stores_are_left_to_sparks_writer(spark):
    assert S.local_folder(spark, "file:///tmp/a b") == S.local_folder(spark, "/tmp/a b") == "/tmp/a b"
    root = tempfile.mkdtemp(prefix="gw-store-")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.gwstore.link./out", f"file://{root}")
    assert S.local_folder(spark, "viewfs://gwstore/out/new") is None
    S.raw_files_sink(spark.createDataFrame([("1", "2008-02-02 15:36:08", 116.5, 39.9)], S.RAW_SCHEMA), "viewfs://gwstore/out/new")
    S.line_files_sink(spark.createDataFrame([("1", "a")], "vehicle string, value string"), "viewfs://gwstore/out/lines")
    assert _files(f"{root}/new")[0] == {"vehicle=1": ["", "1,2008-02-02 15:36:08,116.5,39.9"]}
    assert _files(f"{root}/lines")[0] == {"vehicle=1": ["", "a"]}


def test_many_small_files_are_read_by_a_few_thousand_tasks(spark):
    d, key = tempfile.mkdtemp(prefix="gw-small-"), "spark.sql.files.maxPartitionBytes"
    for i in range(200):
        with open(f"{d}/{i}.csv", "w") as f:
            f.write(f"{i},2008-02-02 15:36:08,116.5,39.9\n")
    was = spark.conf.get(key)
    spark.conf.set(key, "1")                 # every byte is a partition of its own
    try:
        df = S.raw_csv_scan(spark, d, glob="*.csv")
        assert df.rdd.getNumPartitions() <= 4200
    finally:
        spark.conf.set(key, was)


def test_files_are_listed_by_tasks_in_batches(spark, monkeypatch):
    d = tempfile.mkdtemp(prefix="gw-batch-")
    os.symlink("nowhere", f"{d}/lost")
    for v in range(3):
        os.mkdir(f"{d}/v{v}")
        for i in range(7):
            with open(f"{d}/v{v}/{i}.txt", "w") as f:
                f.write("1" * i)
    with open(f"{d}/v1/.0.txt.crc", "w") as f:
        f.write("a checksum")
    monkeypatch.setattr(S, "LISTED_AT_ONCE", 2)
    monkeypatch.setattr(S, "_driver_listing", None)
    df = S.file_listing(spark, f"{d}/*", "{?.txt,.*}")
    assert sorted((at.split("/")[-2], n, k) for n, k, at in df.collect()) == [(f"v{v}", f"{i}.txt", i) for v in range(3) for i in range(7)]
    assert S.file_listing(spark, f"{d}/none").count() == 0 and S.file_listing(spark, f"{d}/*", "*.md").count() == 0


def test_files_of_other_stores_are_listed_by_the_driver(spark, raw_dir):
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.gwlist.link./in", f"file://{raw_dir}")
    there = {(r.file_name, r.length) for r in S.file_listing(spark, "viewfs://gwlist/in").collect()}
    assert there == {(r.file_name, r.length) for r in S.file_listing(spark, raw_dir).collect()} and len(there) == 3
