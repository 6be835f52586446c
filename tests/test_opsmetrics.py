"""Operational metrics on hand-written event tables (FIXTURES §4)."""

import pytest
from pyspark.sql import functions as F

from gpsweave.operators import opsmetrics as M

SCHEMA = ("event_id long, t string, endpoint string, latency_s double, status_code int, is_error boolean, "
          "cache_hit boolean")


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("ts", F.to_timestamp("t"))


def test_interval_with_only_errors_still_reported(spark):
    df = events(spark, [(1, "2024-01-01 00:00:01", "op", 0.5, 500, True, True),
                        (2, "2024-01-01 00:00:02", "op", 0.7, 500, True, False)])
    r = M.interval_metrics(df, 5).first()
    assert (r.messages, r.errors, r.latency_ms, r.throughput) == (0, 2, 0.0, 0.0)
    assert r.cache_hit_ratio == pytest.approx(0.5)


def test_latency_is_mean_of_successes_in_ms_rounded_like_java(spark):
    df = events(spark, [(1, "2024-01-01 00:00:01", "op", 0.001234, 200, False, True),
                        (2, "2024-01-01 00:00:02", "op", 0.002, 200, False, True),
                        (3, "2024-01-01 00:00:03", "op", 9.0, 500, True, True),
                        (4, "2024-01-01 00:00:07", "op", 0.004, 200, False, True)])
    rows = sorted(M.interval_metrics(df, 5).collect(), key=lambda r: r.interval_start)
    assert rows[0].latency_ms == 1.62 and rows[0].messages == 2 and rows[0].errors == 1
    assert rows[0].throughput == pytest.approx(2 / 5)
    assert rows[1].latency_ms == 4.0


def test_no_cache_lookups_gives_null_ratio(spark):
    df = events(spark, [(1, "2024-01-01 00:00:01", "op", 0.5, 200, False, None)])
    df = df.withColumn("cache_hit", F.lit(None).cast("boolean"))
    r = M.interval_metrics(df, 5).first()
    assert r.cache_hits == 0 and r.cache_misses == 0 and r.cache_hit_ratio is None


def test_error_only_endpoint_is_kept_with_status_counts(spark):
    df = events(spark, [(1, "2024-01-01 00:00:01", "/ok", 0.1, 200, False, True),
                        (2, "2024-01-01 00:00:02", "/bad", 0.2, 500, True, True),
                        (3, "2024-01-01 00:00:03", "/bad", 0.3, 404, True, True)])
    ep = {r.endpoint: r for r in M.endpoint_metrics(df, 5).collect()}
    assert ep["/bad"].request_count == 0 and ep["/bad"].error_count == 2 and ep["/bad"].latency_ms == 0.0
    codes = {(r.endpoint, r.status_code): r.n for r in M.endpoint_status_counts(df, 5).collect()}
    assert codes == {("/ok", "200"): 1, ("/bad", "500"): 1, ("/bad", "404"): 1}
    m = M.endpoint_status_map(df, 5).filter("endpoint = '/bad'").first().status_codes
    assert m == {"500": 1, "404": 1}
    flat = {r.name: r.value for r in M.flatten_endpoints(M.endpoint_metrics(df, 5),
                                                          M.endpoint_status_counts(df, 5)).collect()}
    assert flat["/bad_error_count"] == 2.0 and flat["/ok_200"] == 1.0


def test_metric_series_requires_operator_name(spark):
    df = events(spark, [(1, "2024-01-01 00:00:01", "op", 0.5, 200, False, True)])
    with pytest.raises(ValueError):
        M.metric_series(M.interval_metrics(df, 5).drop("operator_name"))
    lines = M.error_log(events(spark, [(9, "2024-01-01 00:00:01.5", "/x", 0.5, 500, True, True)])).first().line
    assert lines == "[2024-01-01T00:00:01.500000Z] ERROR (/x): status 500"
