"""The counters over time on changes with ties, nulls and many chunks."""

import random

import pytest

from gpsweave.operators.counters import status_changes, status_count_series
from gpsweave.operators.views import STATUSES

SCHEMA = "taxi_id string, arrival_key long, event_id long, status_before string, status string"


def _changes(n, seed=3):
    rng, now, rows = random.Random(seed), {}, []
    for i in range(n):
        v = rng.choice("abcdefgh")
        to = rng.choice([s for s in STATUSES if s != now.get(v)])
        rows.append((v, None if i < 5 else i // 3 * 50, i, now.get(v), to))      # three changes at one position
        now[v] = to
    return rows


@pytest.mark.parametrize("fan_out,chunk", [(2, 64), (3, 1000), (4096, 4096)])
def test_running_counts(spark, fan_out, chunk):
    rows, counts, want = _changes(400), dict.fromkeys(STATUSES, 0), {}
    for v, at, i, before, to in sorted(rows, key=lambda r: (-1 if r[1] is None else r[1], r[2])):
        counts[to] += 1
        if before:
            counts[before] -= 1
        want[i] = dict(counts)
    random.Random(1).shuffle(rows)
    got = status_count_series(spark.createDataFrame(rows, SCHEMA).repartition(7), fan_out, chunk).collect()
    assert {r["event_id"]: {s: r[s] for s in STATUSES} for r in got} == want and len(got) == 400


def test_only_changes_and_empty_tables(spark):
    rows = [("a", 1, 1, None, "active"), ("a", 2, 2, "active", "active"), ("b", 3, 3, None, None), ("a", 4, 4, "active", "removed")]
    changes = status_changes(spark.createDataFrame(rows, SCHEMA))
    assert [r["event_id"] for r in changes.orderBy("event_id").collect()] == [1, 4]
    assert status_count_series(spark.createDataFrame([], SCHEMA)).count() == 0
