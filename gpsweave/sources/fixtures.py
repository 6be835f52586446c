"""Telemetry inputs derived from the driver's ``events`` table.

The reference reads GPS pings; the driver ships TPC-H-like tables and an
``events`` stream. These functions turn ``events`` into the record shapes the
operators read (pings, raw file rows, messages, grid speeds, requests). All
arithmetic that decides a row is integer, so Spark and the DuckDB oracle
(``oracles/fixtures_sql.py``) produce identical rows.

Each user becomes a vehicle; time is compressed 40 times; a vehicle stands for
three pings at a pseudo-random point, then jumps; every 17th ping arrives 300
positions late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.num import idiv
from ..plans.scan import Running, keyed_scan
from .tables import table

# --- fixed values of the fixture definition (FIXTURES.md) ---
EPOCH_S = 1704067200            # 2024-01-01 00:00:00 UTC
EPOCH_US = 1704067200000000
COMPRESS_US = 40000000          # 40 s of event time per fixture second
LAT0_E6, LAT_MUL_USER, LAT_MUL_SLOT, LAT_MOD, LAT_OFF, LAT_STEP = 39916300, 7919, 104729, 2001, 1000, 125
LON0_E6, LON_MUL_USER, LON_MUL_SLOT, LON_MOD, LON_OFF, LON_STEP = 116397200, 6007, 15485863, 2003, 1001, 160
LATE_EVERY, LATE_BY = 17, 300
DAY_US = 86400000000            # scan chunk of the fixture: one day of event time

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


FMT_SQL = f"date_format(timestamp_millis(ts_ms), '{TS_FORMAT}')"


def _sel(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Projection given as SQL expression text (one driver call per column)."""
    return df.select(*[F.expr(e).alias(n) for n, e in cols.items()])


_STORED: dict[tuple[str, str], str] = {}


def store_trips(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Write the pings of ``sf_dir`` once; queries of this application then
    read them from ``path``, as a deployment reads its stored pings."""
    trips(spark, sf_dir).write.mode("overwrite").parquet(path)
    _STORED[spark.sparkContext.applicationId, sf_dir] = path


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ping per event: ``taxi_id, ts_ms, latitude, longitude, end_flag,
    produced_ts, arrival_key, event_id, lat_e6, lon_e6, value, us``."""
    if _STORED and (path := _STORED.get((spark.sparkContext.applicationId, sf_dir))):
        return spark.read.parquet(path)
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "value", F.expr("unix_micros(CAST(ts AS TIMESTAMP))").alias("us"))
    # position in the user's time order and "is the user's last event", both as
    # chunked scans so that one busy user is not a single task
    ev = keyed_scan(ev, ["user_id"], ["us", "event_id"], idiv(F.col("us"), DAY_US), [
        Running("_n", "sum", F.lit(1)),
        Running("_last", "max", F.struct("us", "event_id"), whole=True),
    ], chunk_col="_uchunk")
    g = _sel(ev, {
        "event_id": "event_id", "user_id": "user_id", "value": "value", "us": "us",
        "end_flag": "_last = struct(us, event_id)",
        "s": f"(us - {EPOCH_US}L) div {COMPRESS_US}",
        "lat_e6": f"{LAT0_E6} + (pmod(user_id * {LAT_MUL_USER} + ((_n - 1) div 3) * {LAT_MUL_SLOT}, {LAT_MOD})"
                  f" - {LAT_OFF}) * {LAT_STEP}",
        "lon_e6": f"{LON0_E6} + (pmod(user_id * {LON_MUL_USER} + ((_n - 1) div 3) * {LON_MUL_SLOT}, {LON_MOD})"
                  f" - {LON_OFF}) * {LON_STEP}"})
    return _sel(g, {
        "taxi_id": "CAST(user_id AS STRING)",
        "ts_ms": f"({EPOCH_S} + s) * 1000",
        "latitude": "CAST(lat_e6 AS DOUBLE) / 1000000",
        "longitude": "CAST(lon_e6 AS DOUBLE) / 1000000",
        "end_flag": "end_flag",
        "produced_ts": "CAST(us AS DOUBLE) / 1000000",
        "arrival_key": f"event_id + CASE WHEN pmod(event_id, {LATE_EVERY}) = 0 THEN {LATE_BY} ELSE 0 END",
        "event_id": "event_id", "lat_e6": "lat_e6", "lon_e6": "lon_e6", "value": "value", "us": "us"})


def _e6_text(col: str) -> str:
    """``116.397200`` from ``116397200`` without floating point."""
    return f"concat(CAST({col} div 1000000 AS STRING), '.', lpad(CAST(pmod({col}, 1000000) AS STRING), 6, '0'))"


def messages(trips_df: DataFrame) -> DataFrame:
    """Wire text of each ping (input of the parser), with malformed lines mixed in."""
    good = (f"concat_ws(',', taxi_id, {FMT_SQL}, {_e6_text('lon_e6')}, {_e6_text('lat_e6')}, "
            "CASE WHEN end_flag THEN ' True ' ELSE '0' END, CAST(ts_ms div 1000 AS STRING))")
    return _sel(trips_df, {
        "event_id": "event_id", "arrival_key": "arrival_key",
        "message": ("CASE WHEN pmod(event_id, 97) = 0 THEN 'taxi_id,date_time,longitude,latitude,end_flag' "
                    "WHEN pmod(event_id, 89) = 0 THEN concat(taxi_id, ',bad-date,116.4,39.9,0,1.0') "
                    "WHEN pmod(event_id, 83) = 0 THEN concat(taxi_id, ',2024-01-01 00:00:00,116.4') "
                    "WHEN pmod(event_id, 79) = 0 THEN concat(taxi_id, ',2024-01-01 00:00:00,abc,39.9,0,1.0') "
                    f"ELSE {good} END")})


def raw_pings(trips_df: DataFrame) -> DataFrame:
    """Rows of the raw per-vehicle files, with bad dates and off-map points."""
    return _sel(trips_df, {
        "event_id": "event_id", "arrival_key": "arrival_key", "taxi_id": "taxi_id",
        "date_time": f"CASE WHEN pmod(event_id, 89) = 0 THEN 'not a date' ELSE {FMT_SQL} END",
        "longitude": ("CASE WHEN pmod(event_id, 71) = 0 THEN 100.0D WHEN pmod(event_id, 67) = 0 THEN 125.0D "
                      "WHEN pmod(event_id, 61) = 0 THEN CAST(NULL AS DOUBLE) ELSE longitude END"),
        "latitude": "CASE WHEN pmod(event_id, 59) = 0 THEN 45.5D ELSE latitude END"})


def file_lines(trips_df: DataFrame) -> DataFrame:
    """``file_name, line`` of the raw files; every 53rd line is blank."""
    return _sel(trips_df, {
        "file_name": "concat('veh_', taxi_id, '.txt')",
        "line": f"CASE WHEN pmod(event_id, 53) = 0 THEN '  ' ELSE concat(taxi_id, ',', {FMT_SQL}) END"})


def file_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing of raw files: one per customer key, most of them empty."""
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("veh_"), F.col("c_custkey").cast("string"), F.lit(".txt")).alias("file_name"))


def grid_speeds(trips_df: DataFrame) -> DataFrame:
    """Per-ping speeds for the traffic grid, on the uncompressed event time."""
    return trips_df.select("taxi_id", "event_id", "ts_ms", "latitude", "longitude",
                           (F.col("value") / 10).alias("speed_kmph"), F.timestamp_micros("us").alias("ts"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Endpoint requests for the operational metrics."""
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"),
        F.col("event_type").alias("endpoint"),
        (F.col("value") / 1000).alias("latency_s"),
        F.when(F.pmod(eid, F.lit(13)) == 0, 500).when(F.pmod(eid, F.lit(7)) == 0, 404)
        .otherwise(200).alias("status_code"),
        (F.pmod(eid, F.lit(13)) == 0).alias("is_error"),
        (F.pmod(eid, F.lit(3)) != 0).alias("cache_hit"))
