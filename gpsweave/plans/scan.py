"""Running aggregates per key that do not put a hot key into one task.

``Window.partitionBy(key).orderBy(order)`` sends every row of a key to one
task. One vehicle may hold a third of all pings, so the per-vehicle scans of
this package are computed in two levels instead (a parallel prefix scan):

1. rows are split into *chunks*: ``chunk = f(order)`` must be non-decreasing
   in the order, so a chunk is a contiguous run of one key's rows
   (``row_chunks`` sizes them by the key's own number of rows);
2. running aggregates are computed within ``(key, chunk)`` by a window;
3. one summary row per ``(key, chunk)`` (a partial aggregate, small) gets the
   aggregate of all *earlier* chunks of its key by a window over the summary;
4. the carry is joined back on ``(key, chunk)`` and combined with the local
   value.

The summary of a key with very many chunks is itself cut (``carries``): groups of
``fan_out`` neighbouring chunks are summed into one row each, these again, until a
level has at most ``fan_out`` rows of any key. The carries then come down the
tree, by windows over at most ``fan_out`` rows each.

The big rows are shuffled once, on ``(key, chunk)``; the summary and carry are
one row per chunk. The join back finds its big side already partitioned and
sorted on ``(key, chunk)``, and AQE turns it into a broadcast when the carry
is measured small. Only associative aggregates qualify: sum, max, min and
``last`` (last non-null value, which also gives ``lag`` over a filtered subset).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.num import idiv
from .materialize import materialize

KINDS = ("sum", "max", "min", "last")


@dataclass(frozen=True)
class Running:
    """One running aggregate: ``kind`` of ``expr`` over the key's earlier rows.

    ``inclusive`` includes the current row; ``whole`` aggregates over all rows
    of the key instead of a prefix. Sums over an empty prefix are 0; the other
    kinds are null.
    """
    name: str
    kind: str
    expr: Column
    inclusive: bool = True
    whole: bool = False

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unsupported running aggregate {self.kind!r}")


def _window_agg(kind: str, e: Column) -> Column:
    if kind == "sum":
        return F.sum(e)
    if kind == "max":
        return F.max(e)
    if kind == "min":
        return F.min(e)
    return F.last(e, ignorenulls=True)


def _combine(kind: str, carry: Column, local: Column) -> Column:
    if kind == "sum":
        return F.coalesce(carry, F.lit(0)) + F.coalesce(local, F.lit(0))
    if kind == "max":
        return F.greatest(carry, local)
    if kind == "min":
        return F.least(carry, local)
    return F.coalesce(local, carry)


def _over_rows(kind: str, value: Column, order: Column) -> Column:
    """The aggregate of ``kind`` over a group of summary rows."""
    return F.max_by(value, F.when(value.isNotNull(), order)) if kind == "last" else _window_agg(kind, value)


def carries(summary: DataFrame, keys: list[str], chunk: str, kinds: dict[str, str], fan_out: int) -> DataFrame:
    """``keys``, ``chunk`` and for each column in ``kinds`` (column -> kind) its
    aggregate over the key's earlier summary rows, under the same name.

    ``summary`` has one row per key and chunk. Every level is written once and
    counted: a level goes up until no key has more than ``fan_out`` rows in it,
    and no window sees more rows than that. Null keys are a key.
    """
    parent = f"({chunk} - pmod({chunk}, {fan_out})) div {fan_out}"
    levels = [materialize(summary.select(*keys, chunk, *kinds))]
    while (levels[-1].groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0) > fan_out:
        up = levels[-1].withColumn("_up", F.expr(parent))
        levels.append(materialize(up.groupBy(*keys, "_up").agg(
            *[_over_rows(k, F.col(c), F.col(chunk)).alias(c) for c, k in kinds.items()]).withColumnRenamed("_up", chunk)))
    above = None
    for level in reversed(levels):
        group = [*keys] if above is None else [*keys, "_up"]
        rows = level.withColumn("_up", F.expr(parent))
        w = Window.partitionBy(*group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
        own = rows.select(*keys, chunk, "_up", *[_window_agg(k, F.col(c)).over(w).alias(c) for c, k in kinds.items()])
        if above is not None:
            up = above.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(chunk).alias("_at"),
                              *[F.col(c).alias(f"_a{i}") for i, c in enumerate(kinds)])
            same = F.col("_up") == F.col("_at")
            for i, k in enumerate(keys):
                same &= F.col(k).eqNullSafe(F.col(f"_k{i}"))
            own = own.join(up, same, "left").select(*keys, chunk, *[
                _combine(k, F.col(f"_a{i}"), F.col(c)).alias(c) for i, (c, k) in enumerate(kinds.items())])
        above = own.select(*keys, chunk, *kinds)
    return above


def keyed_scan(df: DataFrame, keys: list[str], order: list[str], chunk: Column,
               aggs: list[Running], chunk_col: str = "_chunk", fan_out: int | None = None) -> DataFrame:
    """Add one column per ``Running`` aggregate, computed chunk-wise.

    ``chunk`` must be non-decreasing along ``order`` within a key. The chunk
    column is kept so that several scans chained on one DataFrame reuse the
    same partitioning (no further shuffle of the big rows). ``fan_out`` bounds
    the summary rows a window sees; without it one window sees all of a key's,
    which is meant for chunks of ``row_chunks`` (about one in a million rows).
    """
    if chunk_col not in df.columns:
        df = df.withColumn(chunk_col, chunk)
    part = [*keys, chunk_col]
    w = Window.partitionBy(*part).orderBy(*order)
    ord_struct = F.struct(*[F.col(c) for c in order])

    # chunk summaries: one partial aggregate per (key, chunk)
    summ_aggs = []
    for a in aggs:
        if a.kind == "last":
            # the value at the latest order position where it is not null
            summ_aggs.append(F.max_by(a.expr, F.when(a.expr.isNotNull(), ord_struct))
                             .alias(f"_t_{a.name}"))
        else:
            summ_aggs.append(_window_agg(a.kind, a.expr).alias(f"_t_{a.name}"))
    summary = df.groupBy(*part).agg(*summ_aggs)
    if fan_out and any(a.whole for a in aggs):
        raise ValueError("whole aggregates have no carry tree")
    if fan_out:
        carry = carries(summary, keys, chunk_col, {f"_t_{a.name}": a.kind for a in aggs}, fan_out)
        carry = carry.select(*part, *[F.col(f"_t_{a.name}").alias(f"_c_{a.name}") for a in aggs])
    else:
        prev_chunks = (Window.partitionBy(*keys).orderBy(chunk_col)
                       .rowsBetween(Window.unboundedPreceding, -1))
        all_chunks = (Window.partitionBy(*keys).orderBy(chunk_col)
                      .rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        carry = summary.select(*part, *[
            _window_agg(a.kind, F.col(f"_t_{a.name}"))
            .over(all_chunks if a.whole else prev_chunks).alias(f"_c_{a.name}")
            for a in aggs])

    local = {}
    for a in aggs:
        if a.whole:
            local[f"_l_{a.name}"] = F.lit(None)
        else:
            frame = w.rowsBetween(Window.unboundedPreceding, 0 if a.inclusive else -1)
            local[f"_l_{a.name}"] = _window_agg(a.kind, a.expr).over(frame)
    out = df.withColumns(local).join(carry, part, "left")
    combined = {a.name: F.col(f"_c_{a.name}") if a.whole
                else _combine(a.kind, F.col(f"_c_{a.name}"), F.col(f"_l_{a.name}")) for a in aggs}
    out = out.withColumns(combined)
    return out.drop(*[f"_l_{a.name}" for a in aggs], *[f"_c_{a.name}" for a in aggs])


def row_chunks(df: DataFrame, keys: list[str], order_col: str, target_rows: int,
               chunk_col: str = "_chunk") -> DataFrame:
    """Add chunk ids that cut each key's own rows into ranges of ``order_col``
    of about ``target_rows`` rows each, in order.

    One partial aggregate counts the rows of every key and their range; a key
    with ``n`` rows gets ``ceil(n / target_rows)`` equal ranges. So a key of up
    to ``target_rows`` rows is one chunk (one summary row), and a key holding a
    third of all rows spreads over as many chunks as it needs. The counts are
    written once (one row per key); adaptive execution decides from their size
    how they are joined. Rows whose key is null are one chunk.
    """
    counts = materialize(df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min(order_col).alias("_lo"), F.max(order_col).alias("_hi"))
        .select(*keys, "_lo", (F.col("_hi") - F.col("_lo") + 1).alias("_w"),
                F.ceil(F.col("_n") / F.lit(target_rows)).cast("long").alias("_subs")))
    at = idiv((F.col(order_col) - F.col("_lo")) * F.col("_subs"), F.col("_w"))
    return (df.join(counts, keys, "left").withColumn(chunk_col, F.coalesce(at, F.lit(0)))
            .drop("_lo", "_w", "_subs"))
