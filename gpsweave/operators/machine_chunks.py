"""The trip and status machine (T3–T17, V2) for vehicles of any number of pings.

``machine.trip_chain`` runs a vehicle's pings through windows in one task. Here
they are cut into chunks, and what a chunk does to the state before it is
summed up in one row, a composable function of that state:

* places: discarded pings (a sum), the last forwarded ping (the last one), and
  whether a ping was discarded since (a sum that starts anew);
* totals: a trip's sums start anew at a cut, so a chunk either replaces what came
  in by its tail or adds to it; whether the vehicle stays removed for good is
  known up to one ping, the chunk's first cut, whose gate depends on what came
  in, so both outcomes are summed up; still seconds are a sum, and past the halt
  limit the last step alone says whether the vehicle is halted;
* status: the last event that set it, the last passing ping, the stored total.

The summaries are composed by windows over one row per chunk, and each state
enters the rows as a carry. Classified pings are written once and read for the
three summaries and the result, each with one shuffle on (vehicle, chunk).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..functions.geo import haversine_sql
from ..session import scratch_path
from .machine import _said, _with
from .trips import KEY, late_filter

_CHUNK = [*KEY, "_chunk"]
_PLACES, _TOTALS = ["n_in", "gap_in", "p_in"], ["c_in", "s_in", "dead_in", "still_in", "halted_in"]   # carries
_BY = "PARTITION BY taxi_id, _chunk ORDER BY arrival_key, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND"
UPTO, BEFORE = f"OVER ({_BY} CURRENT ROW)", f"OVER ({_BY} 1 PRECEDING)"
_SO_FAR = "OVER (PARTITION BY taxi_id ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_EARLIER = "OVER (PARTITION BY taxi_id ORDER BY _chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _since(value: str, reset: str, name: str) -> list[dict[str, str]]:
    """Levels of columns that give, in ``name``, the sum of ``value`` over the
    earlier chunks from the last one on that starts anew (``reset``)."""
    return [{f"{name}_sum": f"sum({value}) {_SO_FAR}"},
            {f"{name}_old": f"last(CASE WHEN {reset} THEN {name}_sum - ({value}) END, true) {_EARLIER}",
             f"{name}_all": f"coalesce(sum({value}) {_EARLIER}, 0L)"},
            {name: f"{name}_all - coalesce({name}_old, 0L)"}]


def _levels(df: DataFrame, *levels: dict[str, str]) -> DataFrame:
    for cols in levels:
        df = _with(df, cols)
    return df


def _gate(c: FleetConfig, cents: str, seconds: str, avg: str) -> str:
    return (f"CASE WHEN {seconds} < {c.min_time_s!r}D OR {cents} / 100.0D < {c.min_distance_km!r}D THEN 'average_skipped' "
            f"WHEN {avg} > {c.max_speed_kmph!r}D THEN 'average_unrealistic' ELSE 'ok' END")


def _average(cents: str, seconds: str) -> str:
    return f"(floor((({cents} / 100.0D) / (nullif({seconds}, 0L) / 3600.0D)) * 100 + 0.5) / 100)"


def classified(pings: DataFrame, cfg: FleetConfig) -> DataFrame:
    """T3–T5 with the chunks they were found in."""
    df = late_filter(pings, cfg)
    df = _with(df, {"d_center_km": haversine_sql(f"{cfg.center_lat!r}D", f"{cfg.center_lon!r}D", "latitude", "longitude", cfg)})
    return _with(df, {"kind": f"CASE WHEN NOT accepted THEN 'late' WHEN d_center_km > {cfg.remove_radius_km!r}D THEN 'discarded' "
                              "ELSE 'forwarded' END"}).select(*pings.columns, "_chunk", "d_center_km", "kind")


def _places(rows: DataFrame, cfg: FleetConfig) -> DataFrame:
    """What the chunk's own rows say about the forwarded ping before each."""
    return _levels(
        rows,
        {"_place": f"row_number() {UPTO.replace('ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW', '')}",
         "_f": "kind = 'forwarded'", "_d": "kind = 'discarded'", "_far": f"d_center_km > {cfg.warn_radius_km!r}D"},
        {"_n": f"sum(CAST(_d AS BIGINT)) {UPTO}"},
        {"_own": f"last(CASE WHEN _f THEN named_struct('lat', latitude, 'lon', longitude, 'ts', ts_ms, 'far', _far, 'n', _n) END, true) {BEFORE}"},
        {"_gap": "_f AND _n > coalesce(_own.n, 0L)"})


def _place_carry(rows: DataFrame, cfg: FleetConfig) -> DataFrame:
    last = "named_struct('lat', latitude, 'lon', longitude, 'ts', ts_ms, 'far', _far, 'cut', end_flag OR _gap, 'first', _own IS NULL, 'n', _n)"
    s = _places(rows, cfg).groupBy(*_CHUNK).agg(
        F.max("_n").alias("n"), F.expr(f"max_by({last}, CASE WHEN _f THEN _place END)").alias("lastf"))
    s = _levels(_with(s, {"gap": "CAST(n > coalesce(lastf.n, 0L) AS BIGINT)"}), *_since("gap", "lastf IS NOT NULL", "gap_in"))
    # the chunk's first forwarded ping also sees pings discarded before the chunk
    s = _with(s, {"out": "CASE WHEN lastf IS NOT NULL THEN named_struct('lat', lastf.lat, 'lon', lastf.lon, 'ts', lastf.ts, 'far', lastf.far, "
                         "'cut', lastf.cut OR (lastf.first AND gap_in > 0)) END"})
    s = _with(s, {"n_in": f"coalesce(sum(n) {_EARLIER}, 0L)", "p_in": f"last(out, true) {_EARLIER}"})
    return _written(s.select(*_CHUNK, "n_in", (F.col("gap_in") > 0).alias("gap_in"), "p_in"), "places")


def _steps(rows: DataFrame, cfg: FleetConfig) -> DataFrame:
    """Steps and cuts, exact; totals of the chunk's own rows. ``rows`` have their places carry."""
    return _levels(
        _places(rows, cfg),
        {"area_violations": "n_in + _n", "_back": "_f AND (_gap OR (_own IS NULL AND gap_in))",
         "_p": "coalesce(named_struct('lat', _own.lat, 'lon', _own.lon, 'ts', _own.ts, 'far', _own.far), "
               "named_struct('lat', p_in.lat, 'lon', p_in.lon, 'ts', p_in.ts, 'far', p_in.far))".replace("coalesce(", "if(_own IS NOT NULL, ", 1),
         "warned": f"coalesce(last(CASE WHEN _f THEN _far END, true) {UPTO}, p_in.far, false)"},
        {"_cut": "_f AND (end_flag OR _back)"},
        {"_pcut": f"coalesce(last(CASE WHEN _f THEN _cut END, true) {BEFORE}, p_in.cut)"},
        {"_step": "coalesce(_f AND NOT _pcut, false)"},
        {"_km": f"CASE WHEN _step THEN {haversine_sql('_p.lat', '_p.lon', 'latitude', 'longitude', cfg)} END",
         "_s": "CASE WHEN _step THEN CASE WHEN ts_ms > _p.ts THEN (ts_ms - _p.ts) div 1000 ELSE 0L END END"},
        {"_cum_c": f"sum(CAST(CASE WHEN _km > 0 THEN floor(_km * 100 + 0.5) ELSE 0 END AS BIGINT)) {UPTO}",
         "_cum_s": f"sum(coalesce(_s, 0L)) {UPTO}", "_slow": f"_step AND _km < {cfg.min_distance_km!r}D"},
        {"_base": f"last(CASE WHEN _cut THEN named_struct('c', _cum_c, 's', _cum_s) END, true) {BEFORE}"})


def _kept(names: list[str]) -> list:
    """Carries the chunk's rows have already, for the next carry: rows join one."""
    return [F.any_value(c).alias(c) for c in names]


def _total_carry(rows: DataFrame, places: DataFrame, cfg: FleetConfig) -> DataFrame:
    """The places carry with the totals added."""
    df = _with(_steps(rows.join(places, _CHUNK), cfg), {"_oc": "_cum_c - _base.c", "_os": "_cum_s - _base.s"})
    # behind the chunk's first cut a gate is the chunk's own; the first cut's depends on what came in
    df = _with(df, {"_fails": f"coalesce(_back AND {_gate(cfg, '_oc', '_os', _average('_oc', '_os'))} <> 'ok' AND _base IS NOT NULL, false)"})
    df = _with(df, {"_ended": f"coalesce(max(_fails) {BEFORE}, false)"})
    both = {"a": "_base IS NULL", "b": "NOT _ended"}      # live rows if the first cut fails its gate, and if not
    s = df.groupBy(*_CHUNK).agg(
        *_kept(_PLACES), F.max("_cum_c").alias("all_c"), F.max("_cum_s").alias("all_s"),
        F.expr("max_by(named_struct('c', _cum_c, 's', _cum_s), CASE WHEN _cut THEN _place END)").alias("cut"),
        F.expr("min_by(named_struct('c', _cum_c, 's', _cum_s, 'back', _back), CASE WHEN _cut THEN _place END)").alias("first"),
        F.max("_fails").alias("fails"),
        *[F.expr(e).alias(f"{k}_{n}") for k, live in both.items() for n, e in (
            ("still", f"coalesce(sum(CASE WHEN _slow AND {live} THEN _s END), 0L)"),
            ("last", f"max_by(_slow, CASE WHEN _step AND {live} THEN _place END)"),
            ("moves", f"coalesce(max(_step AND NOT _slow AND {live}), false)"))])
    for x in "cs":
        s = _levels(_with(s, {f"tail_{x}": f"all_{x} - coalesce(cut.{x}, 0L)"}), *_since(f"tail_{x}", "cut IS NOT NULL", f"{x}_in"))
    s = _with(s, {"at_c": "c_in + first.c", "at_s": "s_in + first.s"})
    s = _with(s, {"first_fails": f"coalesce(first.back AND {_gate(cfg, 'at_c', 'at_s', _average('at_c', 'at_s'))} <> 'ok', false)"})
    s = _with(s, {"dead_in": f"coalesce(max(first_fails OR fails) {_EARLIER}, false)"})
    pick = "CASE WHEN dead_in THEN {0} WHEN first_fails THEN a_{1} ELSE b_{1} END".format
    s = _with(s, {"still": pick("0L", "still"), "last": pick("NULL", "last"), "moves": pick("false", "moves")})
    s = _with(s, {"still_in": f"coalesce(sum(still) {_EARLIER}, 0L)"})
    # past the limit every still step halts and every other one resumes: the last step decides
    s = _with(s, {"halts": f"CASE WHEN last IS NULL THEN NULL WHEN still_in + still >= {cfg.halt_after_s} THEN last WHEN moves THEN false END"})
    s = _with(s, {"halted_in": f"coalesce(last(halts, true) {_EARLIER}, false)"})
    return _written(s.select(*_CHUNK, *_PLACES, *_TOTALS), "totals")


def _trips(rows: DataFrame, cfg: FleetConfig) -> DataFrame:
    """T9–T17 of every row, exact, and what each row does to the status. ``rows``
    have their places and totals carry."""
    c = cfg
    return _levels(
        _steps(rows, cfg),
        {"_tc": "_cum_c + if(_base IS NULL, c_in, -_base.c)", "_ts": "_cum_s + if(_base IS NULL, s_in, -_base.s)"},
        {"_avg": _average("_tc", "_ts")},
        {"_gate": f"CASE WHEN _f THEN {_gate(c, '_tc', '_ts', '_avg')} END"},
        {"_dead": f"dead_in OR coalesce(max(_back AND _gate <> 'ok') {BEFORE}, false)"},
        {"has_step": "_step AND NOT _dead", "step_km": "CASE WHEN NOT _dead THEN _km END", "step_s": "CASE WHEN NOT _dead THEN _s END",
         "_c": "CASE WHEN _dead THEN 0L ELSE _tc END", "total_time_s": "CASE WHEN _f THEN CASE WHEN _dead THEN 0L ELSE _ts END END",
         "avg_reason": "CASE WHEN _f AND _dead THEN 'average_skipped' ELSE _gate END", "_removed": "_f AND (_back OR _dead)"},
        {"total_distance_km": "CASE WHEN _f THEN _c / 100.0D END", "average_speed_kmph": "CASE WHEN avg_reason = 'ok' THEN _avg END",
         "trip_reset": "CASE WHEN _f AND end_flag THEN 'end_flag' WHEN _removed THEN 'removal' END",
         "area_event": ("CASE WHEN _f AND _far AND NOT coalesce(_p.far, false) THEN 'warn' "
                        "WHEN _f AND NOT _far AND coalesce(_p.far, false) THEN 'reset' END"),
         "_still": "has_step AND _slow"},
        {"still_s_total": f"still_in + coalesce(sum(CASE WHEN _still THEN step_s END) {UPTO}, 0L)"},
        {"_hs": f"CASE WHEN _still AND still_s_total >= {c.halt_after_s} THEN true WHEN has_step AND NOT _still THEN false END"},
        {"halted": f"coalesce(last(_hs, true) {UPTO}, halted_in)", "_was": f"coalesce(last(_hs, true) {BEFORE}, halted_in)"},
        {"halt_event": "CASE WHEN halted AND NOT _was THEN 'halt' WHEN _was AND NOT halted THEN 'resume' END"},
        {"_hset": "CASE WHEN NOT _removed THEN CASE halt_event WHEN 'halt' THEN 'halted' WHEN 'resume' THEN 'active' END END",
         "_passed": "coalesce(avg_reason = 'ok', false)", "_moved": "has_step AND step_km > 0"},
        {"_set": "CASE WHEN _d THEN 'removed' WHEN _passed AND end_flag THEN 'inactive' ELSE _hset END",
         "_wrote": "CASE WHEN _d THEN 0L WHEN coalesce(_moved, false) OR _passed THEN _c END"})


_STATUS = ("CASE WHEN {0}.v = 'halted' THEN 'halted' WHEN {1} IS NOT NULL AND ({0} IS NULL OR {1} >= {0}.at) THEN 'active' ELSE {0}.v END").format
_AT = "named_struct('chunk', _chunk, 'place', _place)"
_SET, _ON = f"CASE WHEN _set IS NOT NULL THEN named_struct('v', _set, 'at', {_AT}) END", f"CASE WHEN _passed AND NOT end_flag THEN {_AT} END"


def _status_carry(trips: DataFrame) -> DataFrame:
    """The places and totals carry with the status added."""
    s = trips.groupBy(*_CHUNK).agg(
        *_kept([*_PLACES, *_TOTALS]), F.expr(f"max_by({_SET}, CASE WHEN _set IS NOT NULL THEN _place END)").alias("set"), F.expr(f"max({_ON})").alias("on"),
        F.expr("max_by(_wrote, CASE WHEN _wrote IS NOT NULL THEN _place END)").alias("wrote"), F.count("trip_reset").alias("resets"))
    s = _with(s, {"set_in": f"last(set, true) {_EARLIER}", "on_in": f"last(on, true) {_EARLIER}", "stored_in": f"coalesce(last(wrote, true) {_EARLIER}, 0L)",
                  "trips_in": f"coalesce(sum(resets) {_EARLIER}, 0L)"})
    return _written(s.select(*_CHUNK, *_PLACES, *_TOTALS, "set_in", "on_in", "stored_in", "trips_in"), "status")


def trip_chain_chunked(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """The rows and columns of ``machine.trip_chain``, with a vehicle's pings cut
    into chunks of about ``cfg.scan_chunk_rows``. An empty table gives no rows."""
    rows = _written(classified(pings, cfg), "classified")
    places = _place_carry(rows, cfg)
    totals = _total_carry(rows, places, cfg)
    trips = _trips(rows.join(totals, _CHUNK), cfg)
    df = _levels(
        _trips(rows.join(_status_carry(trips), _CHUNK), cfg),
        {"_last": f"coalesce(last({_SET}, true) {UPTO}, set_in)", "_on": f"coalesce(last({_ON}, true) {UPTO}, on_in)",
         "_stored": f"coalesce(last(_wrote, true) {UPTO}, stored_in)", "_stored_before": f"coalesce(last(_wrote, true) {BEFORE}, stored_in)",
         "trip_no": f"trips_in + coalesce(count(trip_reset) {BEFORE}, 0L)"},
        {"status": _STATUS("_last", "_on"), "stored_total": "_stored / 100.0D",
         "fleet_delta_cents": "CASE WHEN _moved THEN greatest(_c - _stored_before, 0L) ELSE 0L END"},
        {"status_before": f"CASE WHEN _place = 1 THEN {_STATUS('set_in', 'on_in')} ELSE "
                          "lag(status) OVER (PARTITION BY taxi_id, _chunk ORDER BY arrival_key, event_id) END"})
    return _said(df, pings.columns)
