"""Chunked keyed scans equal plain per-key windows (random data, any chunk span)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from gpsweave.functions.num import idiv
from gpsweave.plans.scan import Running, keyed_scan, row_chunks

rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(-5, 5) | st.none()), min_size=1, max_size=60)


@settings(max_examples=12, deadline=None)
@given(rows=rows_st, span=st.sampled_from([1, 2, 5, 1000]))
def test_keyed_scan_equals_plain_window(spark, rows, span):
    data = [(k, i, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "k int, pos long, v int")
    aggs = [Running("s", "sum", F.col("v")), Running("sx", "sum", F.col("v"), inclusive=False),
            Running("mx", "max", F.col("v")), Running("mn", "min", F.col("v"), inclusive=False),
            Running("lst", "last", F.col("v"), inclusive=False), Running("tot", "max", F.col("v"), whole=True)]
    got = keyed_scan(df, ["k"], ["pos"], idiv(F.col("pos"), span), aggs)
    w = Window.partitionBy("k").orderBy("pos")
    inc, exc = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    want = df.select("k", "pos",
                     F.coalesce(F.sum("v").over(inc), F.lit(0)).alias("s"),
                     F.coalesce(F.sum("v").over(exc), F.lit(0)).alias("sx"),
                     F.max("v").over(inc).alias("mx"), F.min("v").over(exc).alias("mn"),
                     F.last("v", ignorenulls=True).over(exc).alias("lst"),
                     F.max("v").over(Window.partitionBy("k")).alias("tot"))
    cols = ["k", "pos", "s", "sx", "mx", "mn", "lst", "tot"]
    a = sorted(tuple(r) for r in got.select(*cols).collect())
    b = sorted(tuple(r) for r in want.select(*cols).collect())
    assert a == b
    if span < 1000:   # the same by a carry tree of two rows a window
        tree = keyed_scan(df, ["k"], ["pos"], idiv(F.col("pos"), span), aggs[:-1], fan_out=2)
        assert sorted(tuple(r) for r in tree.select(*cols[:-1]).collect()) == sorted(tuple(r) for r in want.select(*cols[:-1]).collect())


def test_carry_tree_has_levels_of_bounded_groups(spark, monkeypatch):
    """One key with 3,000 chunks and a fan-out of 10: levels of 3,000, 300, 30 and 4 rows, right carries, an exact null key."""
    from gpsweave.plans import scan
    sizes, write = [], scan.materialize
    monkeypatch.setattr(scan, "materialize", lambda df: (out := write(df), sizes.append(out.count()))[0])
    df = spark.range(3000).select(F.when(F.col("id") < 0, 1).alias("k"), (F.col("id") - 1500).alias("c"),
                                  (F.col("id") % 7).alias("s"), F.when(F.col("id") % 50 == 3, F.col("id")).alias("last"))
    got = {r.c: (r.s, r.last) for r in scan.carries(df, ["k"], "c", {"s": "sum", "last": "last"}, 10).collect()}
    assert sizes == [3000, 300, 30, 4]
    total, last = 0, None
    for i in range(3000):
        assert (got[i - 1500][0] or 0, got[i - 1500][1]) == (total, last)
        total, last = total + i % 7, i if i % 50 == 3 else last
    empty = spark.createDataFrame([], "k int, pos long, v int")
    assert keyed_scan(empty, ["k"], ["pos"], F.col("pos"), [Running("s", "sum", F.col("v"))], fan_out=2).count() == 0


def test_row_chunks_follow_each_keys_own_rows(spark):
    n = 30000
    # one key holds a third of all positions, 10,000 others two rows each, some rows no key
    df = spark.range(n).select(F.col("id").alias("pos"),
                               F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 100 != 1, F.col("id") % 10000).alias("k"))
    ch = row_chunks(df, ["k"], "pos", target_rows=500)
    sizes = ch.groupBy("k", "_chunk").count()
    hot = sizes.filter("k = -1")
    assert hot.count() == 20                              # 10,000 rows in 500-row chunks
    assert hot.agg(F.max("count")).first()[0] <= 501
    sparse = sizes.filter("k >= 0")
    assert sparse.count() == df.filter("k >= 0").select("k").distinct().count()   # one summary row per key
    assert ch.filter("k IS NULL").count() == df.filter("k IS NULL").count() > 0
    # chunk ids are monotone in position within every key
    w = Window.partitionBy("k").orderBy("pos")
    assert ch.select((F.col("_chunk") < F.lag("_chunk").over(w)).alias("b")).filter("b").count() == 0
