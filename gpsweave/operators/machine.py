"""The per-vehicle trip and status machine (T3–T17, V2) as window expressions.

Every quantity the reference keeps in per-vehicle state is a running aggregate
over the vehicle's earlier pings, in arrival order, once it is written in the
right order:

1. newest time so far (T3), then kind: late, discarded (beyond 15 km), forwarded;
2. the previous forwarded ping, and whether a ping was discarded since (the
   vehicle is then ``removed`` when this ping arrives);
3. trip cuts: totals are cleared after an end flag, and after the first
   forwarded ping that finds the vehicle removed; a step needs a previous
   forwarded ping that didn't cut;
4. totals are running sums since the last cut; the average gate reads them;
5. *dead*: a ping that finds the vehicle removed and fails the gate leaves it
   removed, every later ping is cut too, so nothing passes the gate any more: a
   running "any";
6. still seconds, the halt flag (last step that set or cleared it);
7. status: the last of the events that set it outright (removal, halt, resume,
   passing ping with an end flag), or ``active`` if a passing ping without one
   came later, which doesn't override ``halted``;
8. the stored total (last written value) and the fleet counter's increments.

All windows share one partitioning and one order: one shuffle and one sort, no
Python. The speed anchor (T18) isn't such an aggregate and lives in ``speed.py``.
``lifecycle.VehicleStep`` is the same machine ping by ping, for streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, FleetConfig
from ..functions.geo import haversine_sql
from .lifecycle import MSG_ACTIVE_FROM, MSG_AREA_WARN, MSG_HALTED, MSG_INACTIVE_NEW, MSG_REMOVED, MSG_RESUMED
from .parse import finite_positions

_BY = "PARTITION BY taxi_id ORDER BY arrival_key, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND"
UPTO, BEFORE = f"OVER ({_BY} CURRENT ROW)", f"OVER ({_BY} 1 PRECEDING)"


def _with(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.withColumns({k: F.expr(v) for k, v in cols.items()})


def _message(text: str, **values: str) -> str:
    """A message pattern as SQL concat; placeholders become the given expressions."""
    parts, rest = [], text
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [repr(head)] * bool(head) + [values[name]]
    return f"concat({', '.join(parts + [repr(rest)] * bool(rest))})"


def kinds(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """Adds d_center_km and kind (late, discarded, forwarded)."""
    df = _with(finite_positions(pings), {
        "_newest": f"max(ts_ms) {BEFORE}",
        "d_center_km": haversine_sql(f"{cfg.center_lat!r}D", f"{cfg.center_lon!r}D", "latitude", "longitude", cfg)})
    return _with(df, {"kind": f"CASE WHEN ts_ms < _newest THEN 'late' WHEN d_center_km > {cfg.remove_radius_km!r}D "
                              "THEN 'discarded' ELSE 'forwarded' END"}).drop("_newest")


def _said(df: DataFrame, columns: list[str]) -> DataFrame:
    """The messages of every row, and the columns of the result."""
    df = _with(df, {"_mid": "coalesce(_hset, status_before)"})
    active = " ".join(f"WHEN _mid = '{k}' THEN {_message(v, id='taxi_id')}" for k, v in MSG_ACTIVE_FROM.items() if k)
    texts = {
        "removal": f"CASE WHEN _d AND NOT status_before <=> 'removed' THEN {_message(MSG_REMOVED, id='taxi_id', n='area_violations')} END",
        "area_warning": f"CASE WHEN area_event = 'warn' THEN {_message(MSG_AREA_WARN, id='taxi_id')} END",
        "halt": f"CASE WHEN _hset = 'halted' AND NOT status_before <=> 'halted' THEN {_message(MSG_HALTED, id='taxi_id')} END",
        "resume": f"CASE WHEN _hset = 'active' AND NOT status_before <=> 'active' THEN {_message(MSG_RESUMED, id='taxi_id')} END",
        "inactive": f"CASE WHEN _passed AND end_flag AND _mid IS NULL THEN {_message(MSG_INACTIVE_NEW, id='taxi_id')} END",
        "active": f"CASE WHEN _passed AND NOT end_flag AND NOT coalesce(_mid IN ('halted', 'active'), false) THEN "
                  f"CASE {active} ELSE {_message(MSG_ACTIVE_FROM[None], id='taxi_id')} END END"}
    items = ", ".join(f"named_struct('pos', {i}, 'kind', '{k}', 'message', {t})" for i, (k, t) in enumerate(texts.items()))
    df = _with(df, {"events": f"filter(array({items}), e -> e.message IS NOT NULL)"})
    return df.select(*columns, "d_center_km", "kind", "area_violations", "area_event", "warned", "has_step", "step_km",
                     "step_s", "total_distance_km", "total_time_s", "trip_reset", "trip_no", "avg_reason",
                     "average_speed_kmph", "still_s_total", "halted", "halt_event", "status_before", "status",
                     "stored_total", "fleet_delta_cents", "events")


def trip_chain(pings: DataFrame, cfg: FleetConfig = DEFAULT) -> DataFrame:
    """One row per ping: the input columns and

    kind, d_center_km, area_violations, area_event, warned, has_step, step_km,
    step_s, total_distance_km, total_time_s, trip_reset, trip_no, avg_reason,
    average_speed_kmph, still_s_total, halted, halt_event, status_before,
    status, stored_total, fleet_delta_cents, events (kind and message by
    position within the ping).
    """
    c = cfg
    df = _with(kinds(pings, cfg), {"_rn": "row_number() OVER (PARTITION BY taxi_id ORDER BY arrival_key, event_id)",
                                   "_f": "kind = 'forwarded'", "_d": "kind = 'discarded'",
                                   "_far": f"d_center_km > {c.warn_radius_km!r}D"})
    df = _with(df, {"area_violations": f"sum(CAST(_d AS BIGINT)) {UPTO}"})
    df = _with(df, {"_p": ("last(CASE WHEN _f THEN named_struct('lat', latitude, 'lon', longitude, 'ts', ts_ms, "
                           f"'far', _far, 'n', area_violations) END, true) {BEFORE}"),
                    "warned": f"coalesce(last(CASE WHEN _f THEN _far END, true) {UPTO}, false)"})
    df = _with(df, {"_back": "_f AND area_violations > coalesce(_p.n, 0L)"})
    df = _with(df, {"_cut": "_f AND (end_flag OR _back)"})
    df = _with(df, {"_pcut": f"last(CASE WHEN _f THEN _cut END, true) {BEFORE}"})
    df = _with(df, {"_step": "coalesce(_f AND NOT _pcut, false)"})
    df = _with(df, {
        "_km": f"CASE WHEN _step THEN {haversine_sql('_p.lat', '_p.lon', 'latitude', 'longitude', c)} END",
        "_s": "CASE WHEN _step THEN CASE WHEN ts_ms > _p.ts THEN (ts_ms - _p.ts) div 1000 ELSE 0L END END"})
    df = _with(df, {
        "_cum_c": f"sum(CAST(CASE WHEN _km > 0 THEN floor(_km * 100 + 0.5) ELSE 0 END AS BIGINT)) {UPTO}",
        "_cum_s": f"sum(coalesce(_s, 0L)) {UPTO}"})
    df = _with(df, {"_base": f"last(CASE WHEN _cut THEN named_struct('c', _cum_c, 's', _cum_s) END, true) {BEFORE}"})
    df = _with(df, {"_tc": "_cum_c - coalesce(_base.c, 0L)", "_ts": "_cum_s - coalesce(_base.s, 0L)"})
    df = _with(df, {"_avg": "floor(((_tc / 100.0D) / (nullif(_ts, 0L) / 3600.0D)) * 100 + 0.5) / 100"})
    skipped = f"(_ts < {c.min_time_s!r}D OR _tc / 100.0D < {c.min_distance_km!r}D)"
    df = _with(df, {"_gate": f"CASE WHEN NOT _f THEN NULL WHEN {skipped} THEN 'average_skipped' "
                             f"WHEN _avg > {c.max_speed_kmph!r}D THEN 'average_unrealistic' ELSE 'ok' END"})
    df = _with(df, {"_dead": f"coalesce(max(_back AND _gate <> 'ok') {BEFORE}, false)"})
    df = _with(df, {
        "has_step": "_step AND NOT _dead",
        "step_km": "CASE WHEN NOT _dead THEN _km END", "step_s": "CASE WHEN NOT _dead THEN _s END",
        "_c": "CASE WHEN _dead THEN 0L ELSE _tc END",
        "total_time_s": "CASE WHEN _f THEN CASE WHEN _dead THEN 0L ELSE _ts END END",
        "avg_reason": "CASE WHEN _f AND _dead THEN 'average_skipped' ELSE _gate END",
        "_removed": "_f AND (_back OR _dead)"})
    df = _with(df, {
        "total_distance_km": "CASE WHEN _f THEN _c / 100.0D END",
        "average_speed_kmph": "CASE WHEN avg_reason = 'ok' THEN _avg END",
        "trip_reset": "CASE WHEN _f AND end_flag THEN 'end_flag' WHEN _removed THEN 'removal' END",
        "area_event": ("CASE WHEN _f AND _far AND NOT coalesce(_p.far, false) THEN 'warn' "
                       "WHEN _f AND NOT _far AND coalesce(_p.far, false) THEN 'reset' END"),
        "_still": f"has_step AND step_km < {c.min_distance_km!r}D"})
    df = _with(df, {"trip_no": f"coalesce(count(trip_reset) {BEFORE}, 0L)"})
    df = _with(df, {"still_s_total": f"coalesce(sum(CASE WHEN _still THEN step_s END) {UPTO}, 0L)"})
    df = _with(df, {"_hs": f"CASE WHEN _still AND still_s_total >= {c.halt_after_s} THEN true "
                           "WHEN has_step AND NOT _still THEN false END"})
    df = _with(df, {"halted": f"coalesce(last(_hs, true) {UPTO}, false)", "_was": f"coalesce(last(_hs, true) {BEFORE}, false)"})
    df = _with(df, {"halt_event": "CASE WHEN halted AND NOT _was THEN 'halt' WHEN _was AND NOT halted THEN 'resume' END"})
    df = _with(df, {
        "_hset": "CASE WHEN NOT _removed THEN CASE halt_event WHEN 'halt' THEN 'halted' WHEN 'resume' THEN 'active' END END",
        "_passed": "coalesce(avg_reason = 'ok', false)",
        "_moved": "has_step AND step_km > 0"})
    df = _with(df, {
        "_set": "CASE WHEN _d THEN 'removed' WHEN _passed AND end_flag THEN 'inactive' ELSE _hset END",
        "_wrote": "CASE WHEN _d THEN 0L WHEN coalesce(_moved, false) OR _passed THEN _c END"})
    df = _with(df, {
        "_last": f"last(CASE WHEN _set IS NOT NULL THEN named_struct('v', _set, 'at', _rn) END, true) {UPTO}",
        "_on": f"max(CASE WHEN _passed AND NOT end_flag THEN _rn END) {UPTO}",
        "_stored": f"coalesce(last(_wrote, true) {UPTO}, 0L)",
        "_stored_before": f"coalesce(last(_wrote, true) {BEFORE}, 0L)"})
    df = _with(df, {"status": "CASE WHEN _last.v = 'halted' THEN 'halted' WHEN _on >= coalesce(_last.at, 0) THEN 'active' ELSE _last.v END",
                    "stored_total": "_stored / 100.0D",
                    "fleet_delta_cents": "CASE WHEN _moved THEN greatest(_c - _stored_before, 0L) ELSE 0L END"})
    df = _with(df, {"status_before": "lag(status) OVER (PARTITION BY taxi_id ORDER BY arrival_key, event_id)"})
    return _said(df, pings.columns)
