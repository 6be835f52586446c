"""Wire message text -> typed ping row, dropping what does not parse.

``taxi_id,yyyy-MM-dd HH:mm:ss,longitude,latitude,end_flag,produced_epoch_s``
(extra fields ignored). Header lines start with ``taxi_id``. The timestamp is
UTC. The end flag is true iff the trimmed field is ``1`` or ``true`` in any
case. Positions that aren't finite numbers (``NaN``, ``Infinity``) count as not
parsed. Every lenient parse is a ``try_`` function, so bad rows become null and
are filtered instead of failing the job (the session is ANSI).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TS_PATTERN = "yyyy-MM-dd HH:mm:ss"
PING_COLUMNS = ["taxi_id", "ts_ms", "latitude", "longitude", "end_flag", "produced_ts"]


def finite_positions(pings: DataFrame) -> DataFrame:
    """The pings whose position is finite. One rule for every path: a NaN or
    infinite coordinate has no distance, so the ping is dropped before T3."""
    finite = lambda c: f"(NOT isnan({c}) AND abs({c}) < double('Infinity'))"
    return pings.filter(f"{finite('latitude')} AND {finite('longitude')}")


def parse_columns(parts: Column) -> dict[str, Column]:
    """Typed fields from the split message (``get`` is null past the end)."""
    field = lambda i: F.get(parts, i)
    ts = F.try_to_timestamp(field(1), F.lit(TS_PATTERN))
    flag = F.trim(field(4))
    return {
        "taxi_id": field(0),
        "ts_ms": F.unix_millis(ts),
        "latitude": field(3).try_cast("double"),
        "longitude": field(2).try_cast("double"),
        "end_flag": (flag == "1") | (F.lower(flag) == "true"),
        "produced_ts": field(5).try_cast("double"),
    }


def parse_pings(messages: DataFrame, value_col: str = "message", keep: list[str] = ()) -> DataFrame:
    """Typed pings from message text; header and unparseable lines are dropped.

    The text is split once into a column. Rows that do not parse yield an empty
    array that ``explode`` drops: unlike a filter on the parsed fields, this is
    not pushed below the projections, so the split is not re-inlined per field
    and generated code stays small.
    """
    split = (messages.filter(~F.col(value_col).startswith("taxi_id"))
             .select(*keep, F.split(F.col(value_col), ",").alias("_f")))
    cols = parse_columns(F.col("_f"))
    parsed = F.struct(*[c.alias(n) for n, c in cols.items()])
    ok = None
    for c in cols.values():
        ok = c.isNotNull() if ok is None else ok & c.isNotNull()
    out = split.select(*keep, F.explode(F.when(ok, F.array(parsed))).alias("_p"))
    return finite_positions(out.select(*keep, *[F.col(f"_p.{n}").alias(n) for n in PING_COLUMNS]))
