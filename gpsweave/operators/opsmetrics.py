"""Operational metrics (M1–M6) over a table of recorded events.

The reference accumulates counters in memory and writes one JSON line per
interval. Here the same figures are tumbling-window aggregates over the event
rows (``requests``: ``ts, endpoint, latency_s, status_code, is_error,
cache_hit``), so they can be recomputed for any interval length and in streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import round_half_up
from ..functions.num import idiv


def _micros(seconds: str):
    """Whole microseconds, so that sums don't depend on the partitioning."""
    return F.floor(F.col(seconds) * 1e6 + 0.5).cast("long")


def _win(interval_s: int):
    return F.window(F.col("ts"), f"{interval_s} seconds").alias("window")


def interval_metrics(events: DataFrame, interval_s: int, operator_col: str = "endpoint") -> DataFrame:
    """M1 + M2: per operator and interval: mean latency of successes (ms, to 2
    decimals), throughput = successes / interval, errors, cache hit ratio (null
    when no cache lookups). Intervals with neither messages nor errors do not
    appear (there is no row to group)."""
    ok = ~F.col("is_error")
    m = events.groupBy(_win(interval_s), F.col(operator_col).alias("operator_name")).agg(
        F.sum(F.when(ok, _micros("latency_s"))).alias("_micros"),
        F.count_if(ok).alias("messages"),
        F.count_if(F.col("is_error")).alias("errors"),
        F.count_if(F.col("cache_hit")).alias("cache_hits"),
        F.count_if(~F.col("cache_hit")).alias("cache_misses"))
    return m.select(
        "operator_name", F.col("window.start").alias("interval_start"),
        F.coalesce(round_half_up(F.try_divide(F.col("_micros"), F.col("messages")) / 1000, 2), F.lit(0.0)).alias("latency_ms"),
        (F.col("messages") / float(interval_s)).alias("throughput"),
        "messages", "errors", "cache_hits", "cache_misses",
        F.try_divide(F.col("cache_hits"), F.col("cache_hits") + F.col("cache_misses")).alias("cache_hit_ratio"))


def endpoint_metrics(events: DataFrame, interval_s: int) -> DataFrame:
    """M3: per interval and endpoint: requests, errors, mean latency (ms),
    requests per second. Endpoints that only had errors are kept."""
    ok = ~F.col("is_error")
    m = events.groupBy(_win(interval_s), "endpoint").agg(
        F.count_if(ok).alias("request_count"),
        F.count_if(F.col("is_error")).alias("error_count"),
        F.sum(F.when(ok, _micros("latency_s"))).alias("_micros"))
    return m.select(F.col("window.start").alias("interval_start"), "endpoint", "request_count", "error_count",
                    F.coalesce(F.try_divide(F.col("_micros"), F.col("request_count")) / 1000, F.lit(0.0)).alias("latency_ms"),
                    (F.col("request_count") / float(interval_s)).alias("req_per_sec"))


def endpoint_status_counts(events: DataFrame, interval_s: int) -> DataFrame:
    """M3: requests per status code, per interval and endpoint (long form)."""
    return (events.groupBy(_win(interval_s), "endpoint", "status_code").agg(F.count("*").alias("n"))
            .select(F.col("window.start").alias("interval_start"), "endpoint",
                    F.col("status_code").cast("string").alias("status_code"), "n"))


def endpoint_status_map(events: DataFrame, interval_s: int) -> DataFrame:
    """M3 as logged: one row per interval and endpoint with a code -> count map."""
    c = endpoint_status_counts(events, interval_s)
    return c.groupBy("interval_start", "endpoint").agg(
        F.map_from_entries(F.collect_list(F.struct("status_code", "n"))).alias("status_codes"))


def flatten_endpoints(endpoint_rows: DataFrame, status_rows: DataFrame) -> DataFrame:
    """M4: nested endpoint metrics as ``<endpoint>_<metric>`` name/value pairs
    (long form; ``pivot`` on ``name`` gives the wide table)."""
    metric_cols = ["request_count", "error_count", "latency_ms", "req_per_sec"]
    stacked = endpoint_rows.select(
        "interval_start", "endpoint",
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
                            for m in metric_cols])).alias("kv"))
    codes = status_rows.select("interval_start", "endpoint",
                               F.struct(F.col("status_code").alias("metric"),
                                        F.col("n").cast("double").alias("value")).alias("kv"))
    both = stacked.unionByName(codes)
    return both.select("interval_start", F.concat_ws("_", "endpoint", "kv.metric").alias("name"),
                       F.col("kv.value").alias("value"))


def metric_series(metrics: DataFrame) -> DataFrame:
    """M5: (operator, metric, time, value) series of every column of a metric
    log other than the operator and the time; a log without operators is an
    error."""
    if "operator_name" not in metrics.columns:
        raise ValueError("the metric log doesn't name its operators")
    names = [c for c in metrics.columns if c not in ("operator_name", "interval_start")]
    return metrics.select("operator_name", "interval_start", *[F.col(c).cast("double").alias(c) for c in names]).unpivot(
        ["operator_name", "interval_start"], names, "metric", "value")


def error_log(events: DataFrame) -> DataFrame:
    """M6: ``[ts] ERROR (endpoint): message`` lines of the failed requests."""
    ts_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return events.filter("is_error").select(
        "event_id", "endpoint",
        F.format_string("[%s] ERROR (%s): status %d", ts_text, F.col("endpoint"), F.col("status_code"))
        .alias("line"))


def latency_metrics(stats: DataFrame, interval_s: int) -> DataFrame:
    """T23 in M1: mean end-to-end latency (ms, 2 decimals) and throughput of the
    stats rows per interval of the time they were processed. ``stats`` has
    ``processed_ms`` and ``produced_ms``."""
    start = idiv(F.col("processed_ms"), interval_s * 1000) * interval_s
    m = stats.groupBy(start.alias("interval_start_s")).agg(
        F.sum(F.col("processed_ms") - F.col("produced_ms")).alias("_ms"), F.count(F.lit(1)).alias("messages"))
    return m.select("interval_start_s", round_half_up(F.col("_ms") / F.col("messages"), 2).alias("latency_ms"),
                    (F.col("messages") / float(interval_s)).alias("throughput"), "messages")
