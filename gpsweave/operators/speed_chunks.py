"""T18/T20 for vehicles of any number of pings: the speed anchor, chunk by chunk.

A chunk is a run of one vehicle's forwarded pings in arrival order. Two runs of
the anchor over the same pings are equal from the first ping that both accept,
so:

1. every chunk is run as if it came first, and its rows are written with that
   run's results;
2. a chunk whose predecessor ends with an anchor starts again from it, but only
   until it accepts a ping that the written run accepted too: mostly a few
   pings. Only the chunks' first rows are read for that, more of them for the
   chunks that haven't met their run yet;
3. a chunk that never meets its run ends with another anchor than written; its
   successor then starts again, until no end changes;
4. speeding outputs of a trip that began before the chunk are added to its rows
   up to the trip's end; they come from a running sum over one row per chunk.

Tasks hold batches of chunks' rows, never a vehicle's.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..plans.scan import row_chunks
from ..session import scratch_path
from .speed import _IN, anchor_step
from .trips import KEY, ORDER, fence_steps

HEAD = 256           # rows of a chunk read first to meet its written run
_CHUNK = [*KEY, "_chunk"]
_RUN = "speed_reason string, speed_kmph double, is_speeding boolean, speeding_no long, speeding_count long"
_RUN_NAMES = ["speed_reason", "speed_kmph", "is_speeding", "speeding_no", "speeding_count"]
_RUN_TYPES = [pa.string(), pa.float64(), pa.bool_(), pa.int64(), pa.int64()]
_STATE = pa.struct([("lat", pa.float64()), ("lon", pa.float64()), ("ts", pa.int64())])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _columns(batch, *names):
    return zip(*(batch.column(c).to_pylist() for c in names))


def _batch(rows, names, types):
    cols = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _first_runs(cfg: FleetConfig):
    """Each chunk run on its own: the rows with their results, their place in
    the chunk, whether they moved the anchor, and the trips ended before them."""
    step = anchor_step(cfg)
    names, types = [*_RUN_NAMES, "place", "moved", "ends"], [*_RUN_TYPES, pa.int64(), pa.bool_(), pa.int64()]

    def run(batches):
        key, anchor, count, place, ends = None, None, 0, 0, 0
        for batch in batches:
            out = []
            for tid, chunk, ts, lat, lon, end in _columns(batch, *_CHUNK, "ts_ms", "latitude", "longitude", "end_flag"):
                if (tid, chunk) != key:
                    key, anchor, count, place, ends = (tid, chunk), None, 0, 0, 0
                reason, speed, fast, number, anchor, count, moved = step(anchor, count, ts, lat, lon, end)
                out.append((reason, speed, fast, number, count, place, moved, ends))
                place, ends = place + 1, ends + (moved and end)
            new = _batch(out, names, types)
            yield pa.RecordBatch.from_arrays([*batch.columns, *new.columns], [*batch.schema.names, *names])
    return run


_HEAD_NAMES = [*_CHUNK, "place", *_RUN_NAMES, "ended", "met", "state", "own", "own_ends"]
_HEAD_TYPES = [pa.string(), pa.int64(), pa.int64(), *_RUN_TYPES, pa.int64(), pa.bool_(), _STATE, pa.int64(), pa.int64()]
_HEAD = (f"taxi_id string, _chunk long, place long, {_RUN}, ended long, met boolean, state struct<lat: double, lon: double, ts: bigint>, "
         "own long, own_ends long")


def _heads(cfg: FleetConfig):
    """Heads of chunks run from the anchor in ``start``, up to the ping at which
    the run meets the written one: results, trips ended up to and with the row;
    the written run's count and ended trips there."""
    step = anchor_step(cfg)

    def run(batches):
        key, anchor, count, met, ended = None, None, 0, False, 0
        for batch in batches:
            out = []
            for tid, chunk, place, ts, lat, lon, end, moved, start, own, ends in _columns(
                    batch, *_CHUNK, "place", "ts_ms", "latitude", "longitude", "end_flag", "moved", "start", "speeding_count", "ends"):
                if (tid, chunk) != key:
                    key, met, count, ended = (tid, chunk), False, 0, 0
                    anchor = start["lat"], start["lon"], start["ts"]
                if met:
                    continue
                reason, speed, fast, number, anchor, count, moves = step(anchor, count, ts, lat, lon, end)
                ended, met = ended + (moves and end), moves and moved
                state = anchor and dict(zip(("lat", "lon", "ts"), anchor))
                out.append((tid, chunk, place, reason, speed, fast, number, count, ended, met, state, own, ends + (moved and end)))
            yield _batch(out, _HEAD_NAMES, _HEAD_TYPES)
    return run


def _replayed(first: DataFrame, todo: DataFrame, cfg: FleetConfig, head: int) -> DataFrame:
    """Heads of the chunks in ``todo`` (chunk, rows, start), as long as each needs."""
    done = None
    while True:
        rows = first.filter(F.col("place") < head).join(todo, _CHUNK).select(
            *_CHUNK, "place", "ts_ms", "latitude", "longitude", "end_flag", "moved", "start", "speeding_count", "ends")
        out = _written(rows.repartition(*_CHUNK).sortWithinPartitions(*_CHUNK, "place").mapInArrow(_heads(cfg), _HEAD), "speed-heads")
        ready = out.groupBy(*_CHUNK).agg(F.max("met").alias("met")).join(todo, _CHUNK).withColumn("ready", F.col("met") | (F.col("rows") <= head))
        ready = _written(ready, "speed-ready")
        own = out.join(ready.filter("ready").select(*_CHUNK), _CHUNK, "left_semi")
        done = own if done is None else done.unionByName(own)
        todo = ready.filter("NOT ready").select(*todo.columns)
        if todo.isEmpty():
            return _written(done, "speed-heads")
        head *= 16


def speed_chain_chunked(pings: DataFrame, cfg: FleetConfig = DEFAULT, head: int = HEAD) -> DataFrame:
    """The rows of ``speed.speed_chain``, with a vehicle's pings cut into chunks
    of about ``cfg.scan_chunk_rows``. Repeated pings are rows of their own; a
    table without forwarded pings gives no rows."""
    forwarded = _written(fence_steps(pings.select(*_IN), cfg).filter("forwarded").select(*_IN), "forwarded")
    rows = row_chunks(forwarded, KEY, "arrival_key", cfg.scan_chunk_rows).select(*_IN, "_chunk")
    rows = rows.repartition(*_CHUNK).sortWithinPartitions(*_CHUNK, *ORDER)
    first = _written(rows.mapInArrow(_first_runs(cfg), ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
                                     + f", {_RUN}, place long, moved boolean, ends long"), "speed-first")
    anchor = F.max_by(F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), F.col("ts_ms").alias("ts")), F.when(F.col("moved"), F.col("place")))
    ended = F.max_by("end_flag", F.when(F.col("moved"), F.col("place")))
    chunks = _written(first.groupBy(*_CHUNK).agg(
        (F.max("place") + 1).alias("rows"), F.when(~ended, anchor).alias("end"),
        F.max_by("speeding_count", "place").alias("last_count"),
        F.sum((F.col("moved") & F.col("end_flag")).cast("long")).alias("last_ends")), "speed-chunks")

    in_order = Window.partitionBy(*KEY).orderBy("_chunk")
    ends, used, heads = chunks.select(*_CHUNK, "rows", "end"), None, None
    while True:
        starts = ends.withColumn("start", F.lag("end").over(in_order))
        todo = starts if used is None else starts.join(used, _CHUNK).filter(~F.col("start").eqNullSafe(F.col("used")))
        todo = _written(todo.select(*_CHUNK, "rows", "start"), "speed-todo")
        if used is not None and todo.isEmpty():
            break
        new = _replayed(first, todo.filter("start IS NOT NULL"), cfg, head)
        if heads is not None:
            new = _written(heads.join(todo.select(*_CHUNK), _CHUNK, "left_anti").unionByName(new), "speed-heads")
        heads = new
        used = _written(starts.select(*_CHUNK, F.col("start").alias("used")), "speed-used")
        # a chunk that met its run ends as written, another with its head's last anchor
        last = heads.groupBy(*_CHUNK).agg(F.max("met").alias("met"), F.max_by(F.struct("state"), "place").alias("last"))
        ends = _written(chunks.join(last, _CHUNK, "left").select(
            *_CHUNK, "rows", F.when(F.coalesce("met", F.lit(True)), F.col("end")).otherwise(F.col("last.state")).alias("end")), "speed-ends")
    return _assembled(first, heads, chunks, in_order)


def _assembled(first: DataFrame, heads: DataFrame, chunks: DataFrame, in_order) -> DataFrame:
    """The written runs with their heads replaced and the counts of trips that go on added."""
    meet = heads.filter("met").select(*_CHUNK, F.col("place").alias("at"), (F.col("speeding_count") - F.col("own")).alias("more"),
                                      F.col("own_ends").alias("at_ends"), (F.col("ended") == 0).alias("goes_on"))
    alone = (heads.groupBy(*_CHUNK).agg(F.max("met").alias("met"), F.max_by("speeding_count", "place").alias("head_count"), F.max("ended").alias("head_ends")))
    info = chunks.join(alone, _CHUNK, "left").join(meet, _CHUNK, "left")
    # what a chunk leaves for the next: a count of its own (reset) or one to add to what came in
    info = info.select(*_CHUNK, "at", "more", "at_ends", "goes_on", "met", F.expr(
        "CASE WHEN met IS NULL THEN true WHEN NOT met THEN head_ends > 0 WHEN last_ends > at_ends THEN true ELSE NOT goes_on END").alias("reset"), F.expr(
        "CASE WHEN met IS NULL OR last_ends > at_ends THEN last_count WHEN NOT met THEN head_count ELSE last_count + more END").alias("left"))
    info = info.withColumn("sum", F.sum("left").over(in_order))
    info = info.withColumn("base", F.last(F.when(F.col("reset"), F.col("sum") - F.col("left")), ignorenulls=True).over(in_order))
    incoming = F.lag(F.col("sum") - F.coalesce("base", F.lit(0))).over(in_order)
    info = _written(info.select(*_CHUNK, "at", "more", "at_ends", "goes_on", "met", F.coalesce(incoming, F.lit(0)).alias("before")), "speed-info")

    head = heads.select(*_CHUNK, "place", F.struct(*_RUN_NAMES, "ended").alias("h"))
    rows = first.join(info, _CHUNK).join(head, [*_CHUNK, "place"], "left")
    closes = F.expr("moved AND end_flag")
    open_ = F.expr("met AND place > at AND ends = at_ends")     # behind the meeting point, in its trip
    more = F.when(open_, F.col("more") + F.when(F.col("goes_on"), F.col("before")).otherwise(0)).otherwise(0)
    # a head's row is in the trip that came in if none ended before it
    closed = F.expr("h.ended - CAST(h.speeding_count = 0 AND h.speed_reason IN ('first', 'ok') AND end_flag AS BIGINT)")
    number = F.when(F.col("h").isNull(), F.col("speeding_no") + more).otherwise(
        F.col("h.speeding_no") + F.when(closed == 0, F.col("before")).otherwise(0))
    count = F.when(F.col("h").isNull(), F.col("speeding_count") + F.when(closes, 0).otherwise(more)).otherwise(
        F.col("h.speeding_count") + F.when(F.col("h.ended") == 0, F.col("before")).otherwise(0))
    pick = {c: F.when(F.col("h").isNull(), F.col(c)).otherwise(F.col(f"h.{c}")) for c in _RUN_NAMES[:3]}
    return rows.select(*_IN[:6], *[e.alias(c) for c, e in pick.items()], number.alias("speeding_no"), count.alias("speeding_count"))
