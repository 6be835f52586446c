"""Batch preparation and audits of raw GPS files (Q1–Q13).

Raw rows carry ``taxi_id, date_time, longitude, latitude`` plus their position
in the input (``arrival_key, event_id`` = file order). Everything is a
DataFrame expression; per-vehicle order questions use the chunked scans of
``plans/scan.py`` and global order questions aggregate first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..functions.num import idiv
from ..plans.materialize import materialize
from ..plans.scan import Running, keyed_scan, row_chunks

RAW_COLUMNS = ["taxi_id", "date_time", "longitude", "latitude"]
TS_PATTERN = "yyyy-MM-dd HH:mm:ss"
FILE_ORDER = ["arrival_key", "event_id"]


def positional(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Q1: the first four data columns renamed to the fixed raw schema.

    ``keep`` lists bookkeeping columns (file order) that are not data.
    """
    data = [c for c in df.columns if c not in keep]
    if len(data) != len(RAW_COLUMNS):
        raise ValueError(f"raw rows have {len(data)} fields; {', '.join(RAW_COLUMNS)} are wanted")
    return df.select(*[F.col(c).alias(n) for c, n in zip(data, RAW_COLUMNS)], *keep)


def coerce_timestamps(df: DataFrame) -> DataFrame:
    """Q2: parse ``date_time``; rows whose value does not parse are dropped."""
    ts = F.try_to_timestamp(F.col("date_time").cast("string"), F.lit(TS_PATTERN))
    return df.withColumn("ts", ts).filter(F.col("ts").isNotNull())


def bbox_ok(cfg: FleetConfig = DEFAULT):
    """Q3 predicate: inclusive box; a null coordinate fails."""
    return F.coalesce(F.col("longitude").between(cfg.bbox_lon_min, cfg.bbox_lon_max)
                      & F.col("latitude").between(cfg.bbox_lat_min, cfg.bbox_lat_max), F.lit(False))


def validate_bbox(df: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Q3: keep rows inside the city's bounding box."""
    return df.filter(bbox_ok(cfg))


def add_end_flag(df: DataFrame) -> DataFrame:
    """Q4/Q5: ``end_flag`` = 1 on each vehicle's last row in (time, file) order.
    Rows without a vehicle id stay, with flag 0.

    The last row of every vehicle (a partial aggregate, one row per vehicle) is
    written once and joined back. With no aggregate between the join and its
    shuffles, adaptive execution can split a hot vehicle's partition.
    """
    order = F.struct("ts", *FILE_ORDER)
    last = materialize(df.filter("taxi_id IS NOT NULL").groupBy("taxi_id").agg(F.max(order).alias("_last")))
    return (df.join(last, "taxi_id", "left")
            .withColumn("end_flag", F.coalesce((order == F.col("_last")).cast("int"), F.lit(0)))
            .drop("_last"))


def time_sort(df: DataFrame) -> DataFrame:
    """Q6: final order by time (ties by vehicle and file order), range-partitioned."""
    return df.orderBy("ts", "taxi_id", *FILE_ORDER)


def drop_nulls(df: DataFrame) -> DataFrame:
    """Q7: library option, off in the pipeline."""
    return df.dropna()


def drop_duplicates(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Q7: library option, off in the pipeline."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def prepare(raw: DataFrame, cfg: FleetConfig = DEFAULT, dropna: bool = False,
            dedupe: bool = False) -> DataFrame:
    """Q1–Q6 as one pipeline: the prepared ping table (``end_flag`` added)."""
    df = coerce_timestamps(raw)
    if dropna:
        df = drop_nulls(df)
    df = validate_bbox(df, cfg)
    if dedupe:
        df = drop_duplicates(df, RAW_COLUMNS)
    return add_end_flag(df)


def prep_report(raw: DataFrame, files: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Q8: one row of counts: files, skipped empty files, rows and columns
    before and after, rows dropped by each rule."""
    ts_ok = F.try_to_timestamp(F.col("date_time").cast("string"), F.lit(TS_PATTERN)).isNotNull()
    rows = raw.agg(
        F.count("*").alias("rows_before"),
        F.count_if(~ts_ok).alias("rows_bad_timestamp"),
        F.count_if(ts_ok & ~bbox_ok(cfg)).alias("rows_outside_bbox"),
        F.count_if(ts_ok & bbox_ok(cfg)).alias("rows_after"))
    per_file = raw.groupBy(F.concat(F.lit("veh_"), F.col("taxi_id"), F.lit(".txt")).alias("file_name")).agg(
        F.count("*").alias("n"))
    f = (files.join(per_file, "file_name", "left")
         .agg(F.count("*").alias("files"), F.count_if(F.col("n").isNull()).alias("files_skipped_empty")))
    # two single rows side by side
    return (rows.crossJoin(f).withColumn("cols_before", F.lit(len(RAW_COLUMNS)))
            .withColumn("cols_after", F.lit(len(RAW_COLUMNS) + 1)))


def unsorted_vehicles(raw: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Q9: vehicles whose timestamps decrease somewhere in file order."""
    df = row_chunks(coerce_timestamps(raw), ["taxi_id"], "arrival_key", cfg.scan_chunk_rows)
    df = keyed_scan(df, ["taxi_id"], FILE_ORDER, F.col("_chunk"),
                    [Running("_prev_ts", "last", F.col("ts"), inclusive=False)])
    return df.filter(F.col("_prev_ts") > F.col("ts")).select("taxi_id").distinct()


def file_line_counts(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Q10 per file: non-blank lines (0 for listed files without any line)."""
    counts = (lines.filter(F.length(F.trim(F.col("line"))) > 0)
              .groupBy("file_name").agg(F.count("*").alias("lines")))
    return (files.join(counts, "file_name", "left")
            .select("file_name", F.coalesce(F.col("lines"), F.lit(0)).cast("long").alias("lines")))


def file_line_profile(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Q10 summary: totals, max, min over non-empty files (0 if none), files at
    that minimum, mean over all files, number of empty files."""
    per = file_line_counts(lines, files)
    s = per.agg(
        F.count("*").alias("total_files"), F.sum("lines").alias("total_lines"),
        F.max("lines").alias("max_lines"),
        F.coalesce(F.min(F.when(F.col("lines") > 0, F.col("lines"))), F.lit(0)).alias("min_lines"),
        F.count_if(F.col("lines") == 0).alias("empty_files"))
    at_min = per.groupBy("lines").agg(F.count("*").alias("files_at_min"))
    out = s.join(at_min, s["min_lines"] == at_min["lines"], "left").drop("lines")
    return out.select("total_files", "total_lines", "max_lines", "min_lines",
                      F.coalesce(F.col("files_at_min"), F.lit(0)).alias("files_at_min"),
                      (F.col("total_lines") / F.col("total_files")).alias("avg_lines"), "empty_files")


def order_ratio(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Q11: pings in order / out of order against the immediately preceding
    ping of the vehicle (fleet-wide totals and percentages)."""
    df = row_chunks(pings, ["taxi_id"], "arrival_key", cfg.scan_chunk_rows)
    df = keyed_scan(df, ["taxi_id"], FILE_ORDER, F.col("_chunk"),
                    [Running("_prev_ts", "last", F.col("ts_ms"), inclusive=False)])
    in_order = F.col("_prev_ts").isNull() | (F.col("ts_ms") >= F.col("_prev_ts"))
    c = df.agg(F.count_if(in_order).alias("in_order"), F.count_if(~in_order).alias("out_of_order"))
    total = F.col("in_order") + F.col("out_of_order")
    return c.select("in_order", "out_of_order",
                    (F.col("in_order") * 100.0 / total).alias("in_order_pct"),
                    (F.col("out_of_order") * 100.0 / total).alias("out_of_order_pct"))


def replay_schedule(prepared: DataFrame, bucket_s: int = 86400) -> DataFrame:
    """Q12: replay batches of equal timestamps and the delay to the next batch.

    The file is in time order, so consecutive equal timestamps are all rows of
    one timestamp: aggregate per timestamp first (partial aggregation), then
    find the next timestamp with a scan chunked by day over the small result.
    """
    per_ts = prepared.groupBy("ts").agg(F.count("*").alias("rows"))
    sec = F.unix_seconds(F.col("ts"))
    per_ts = per_ts.withColumn("_neg", -sec).withColumn("_one", F.lit(1))
    nxt = keyed_scan(per_ts, ["_one"], ["_neg"], idiv(F.col("_neg"), bucket_s),
                     [Running("_next_neg", "max", F.col("_neg"), inclusive=False)])
    return nxt.select(F.col("ts").alias("batch_ts"), "rows",
                      (-F.col("_next_neg") - sec).alias("delay_s"))


def stamp_message(prepared: DataFrame, produced: F.Column) -> DataFrame:
    """Q13: wire text = prepared fields joined by commas + producer epoch."""
    return prepared.select("taxi_id", F.concat_ws(
        ",", F.col("taxi_id"), F.date_format("ts", TS_PATTERN), F.col("longitude").cast("string"),
        F.col("latitude").cast("string"), F.col("end_flag").cast("string"), produced.cast("string")
    ).alias("message"))

