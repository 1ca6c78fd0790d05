"""An independent, row-by-row pandas/Python model of the cleaning job, written from the
documented semantics (SURVEY §2-§3), used only as a test oracle on small inputs."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd

# Fixed values, stated here a second time so that a wrong constant of the library shows.
DROP_COLUMNS = """
check_digit event_record_type_code booking_number_y priority_stow_code vessel_code_y voyage_y direction_seq_y equipment_id_y
empty_full_code_y equipment_voyage equipment_direction_seq load_port_code_y discharge_port_code_y destination_port_code_y
previous_load_port_code previous_load_vessel_code mounted_to_equipment_id life_cycle_status current_direction_seq
actual_temperature actual_temperature_scale ingate_trucker_code create_user create_date last_update_user last_update_date
auto_cfs_code b_p_bol_origin_port_code b_p_bol_destination_port_code
""".split()
NON_NEGATIVE_COLUMNS = "port_to_ste_time arrival_to_pickup_time time_to_unload time_til_avp storage_time".split()
REQUIRED_COLUMNS = "consignee_name shipper_name booking_number storage_time arrival_time carrier_code".split()
NULL_FILLS = [("hazard_type_code", "Unknown"), ("current_damage_code", "Unknown"), ("equipment_type_height_code", "Unkown"),
              ("commodity", "Unkown"), ("life_cycle_status_code", "Unknown"), ("pds_code", "Unknown"),
              ("discharge_port_code", "Unknown")]
ONE_HOT_COLUMNS = "empty_full_code trade_route pds_code plan_equip_type_code".split()

TS_FORMAT = "%Y-%m-%d %H:%M:%S"


def _header(name: str) -> str:
    return re.sub(r"[^0-9a-zA-Z]+", "_", name).strip("_").lower() if name != "_rank" else name


def _missing(v) -> bool:
    return v is None or (isinstance(v, float) and math.isnan(v)) or v is pd.NaT


def _as_int(v):
    """Text/number -> int when integral, else None."""
    if _missing(v):
        return None
    try:
        f = float(v)
    except (TypeError, ValueError):
        return None
    return int(f) if math.isfinite(f) and f == int(f) else None


def _as_float(v):
    if _missing(v):
        return None
    try:
        f = float(v)
    except (TypeError, ValueError):
        return None
    return None if math.isnan(f) else f


def _as_ts(v):
    if _missing(v):
        return None
    if isinstance(v, pd.Timestamp):
        return v
    try:
        return pd.Timestamp(pd.to_datetime(v, format=TS_FORMAT))
    except (TypeError, ValueError):
        return None


def _hours(a, b):
    if a is None or b is None:
        return None
    return (b - a) / pd.Timedelta(hours=1)


def _text(v, na="nan"):
    return na if _missing(v) else str(v)


def clean(events: pd.DataFrame, manifest: pd.DataFrame, schedule: pd.DataFrame) -> pd.DataFrame:
    ev = [dict(zip(map(_header, events.columns), row)) for row in events.sort_values("_rank").itertuples(index=False)]
    mf = [dict(zip(map(_header, manifest.columns), row)) for row in manifest.sort_values("_rank").itertuples(index=False)]
    sc = [dict(zip(map(_header, schedule.columns), row)) for row in schedule.sort_values("_rank").itertuples(index=False)]

    for rows in (ev, mf):
        for r in rows:
            r["booking_number"] = _as_int(r["booking_number"])
            r["key"] = f"{_text(r['equipment_id'])}_{_text(r['booking_number'], '<NA>')}"

    # first manifest row per key overwrites the event row's columns (missing key -> None)
    first = {}
    for r in mf:
        first.setdefault(r["key"], r)
    mcols = [c for c in (mf[0].keys() if mf else []) if c not in ("key", "_rank")]
    for r in ev:
        hit = first.get(r["key"])
        for c in mcols:
            r[c] = None if hit is None else hit[c]

    arrival = {}
    for s in sc:
        code = f"{_text(s['vessel_code'])}_{_text(_as_int(s['voyage_number']))}_E"
        arrival.setdefault(code, s["arrival_timestamp"])
    for r in ev:
        v = _as_float(r.get("voyage"))
        r["voyage"] = v
        r["next_voyage"] = _as_int(v + 1) if v is not None else None
        r["voyage_code"] = f"{_text(r['vessel_code'])}_{_text(r['next_voyage'], '<NA>')}_{_text(r['direction_seq'])}"
        r["arrival_time"] = arrival.get(r["voyage_code"])
        for c in DROP_COLUMNS:
            r.pop(c, None)
        for c in ("event_date", "sail_date", "arrival_time"):
            if c in r:
                r[c] = _as_ts(r[c])

    by_key = defaultdict(list)
    for r in ev:
        by_key[r["key"]].append(r)
    for rows in by_key.values():
        hlp = sum(1 for r in rows if r["event_type"] == "HLP")
        pick = next((r["event_date"] for r in rows if r["event_type"] == "OGT"
                     and r["inventory_location_code"] in ("STE1", "STE2") and r["event_date"] is not None), None)
        avp = next((r["event_date"] for r in rows if r["event_type"] == "AVP" and r["event_date"] is not None), None)
        dfv = [r["event_date"] for r in rows if r["event_type"] == "DFV" and r["event_date"] is not None]
        dfv = max(dfv) if dfv else None
        for r in rows:
            a = r["arrival_time"]
            r.update(hlp_count=hlp, pickup_date=pick, avp_date=avp, dfv_event_date=dfv,
                     storage_time=_hours(avp, pick), time_til_avp=_hours(a, avp),
                     avp_day_of_week=None if avp is None else avp.day_name(),
                     time_to_unload=_hours(a, dfv), arrival_to_pickup_time=_hours(a, pick))
            r["port_to_ste_time"] = (None if r["time_til_avp"] is None or r["time_to_unload"] is None
                                     else r["time_til_avp"] - r["time_to_unload"])

    ev = [r for r in ev if all(r[c] is not None and r[c] >= 0 for c in NON_NEGATIVE_COLUMNS)]
    by_key = defaultdict(list)
    for r in ev:
        by_key[r["key"]].append(r)
    for rows in by_key.values():
        ltv = [r["event_date"] for r in rows if r["event_type"] == "LTV" and r["event_date"] is not None]
        for r in rows:
            r["load_date"] = max(ltv) if ltv else None
    for r in ev:
        x = r["arrival_to_pickup_time"]
        r["one_day_pickup"] = int(x is not None and x < 24)
    ev = [r for r in ev if all(not _missing(r[c]) for c in REQUIRED_COLUMNS)]
    for r in ev:
        r["journey_length"] = _hours(r["sail_date"], r["avp_date"])
        for c, v in NULL_FILLS:
            if _missing(r[c]):
                r[c] = v
    cats = {c: sorted({r[c] for r in ev if not _missing(r[c])}) for c in ONE_HOT_COLUMNS}
    for r in ev:
        for c in ONE_HOT_COLUMNS:
            v = r.pop(c)
            for cat in cats[c][1:]:
                r[f"{c}_{cat}"] = int(v == cat)

    # full-row distinct keeping the first copy, then the last row per key
    seen, distinct = set(), []
    for r in ev:
        sig = tuple((k, None if _missing(v) else v) for k, v in sorted(r.items()) if k != "_rank")
        if sig not in seen:
            seen.add(sig)
            distinct.append(r)
    last = {}
    for r in distinct:
        last[r["key"]] = r
    rows = sorted(last.values(), key=lambda r: r["_rank"])
    return pd.DataFrame(_history(rows))


def _decayed(vals):
    """Exact decayed mean: with ages from the newest value, weights are (9/10) ** age as fractions."""
    if not vals:
        return None
    nine_tenths = Fraction(9, 10)
    weighted = sum(Fraction(v) * nine_tenths ** age for age, v in enumerate(reversed(vals)))
    return float(weighted / sum(nine_tenths ** age for age in range(len(vals))))


def _history(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["consignee_name"]].append(r)
    out = []
    for _, g in sorted(groups.items()):
        g.sort(key=lambda r: (r["arrival_time"], r["_rank"]))
        xs, ys = [], []
        for i, r in enumerate(g):
            prev = [x for x in xs if x is not None]
            r = dict(r)
            r["consignee_history_count"] = i
            r["low_history_flag"] = i < 5
            r["lifetime_avg_pickup"] = float(np.mean(prev)) if prev else -1.0
            r["lifetime_std_pickup"] = float(np.std(prev, ddof=1)) if len(prev) > 1 else -1.0
            r["lifetime_median_pickup"] = float(np.median(prev)) if prev else -1.0
            for n in (5, 10):
                win = xs[-n:] if len(xs) >= n else None
                r[f"recent_{n}_avg_pickup"] = (float(np.mean(win)) if win and all(v is not None for v in win)
                                               else -1.0)
            r["weighted_avg_pickup"] = _decayed(prev) if prev else -1.0
            win = ys[-5:] if len(ys) >= 5 else None
            r["recent_5_24h_rate"] = float(np.mean(win)) if win else -1.0
            r["last_one_day_pickup"] = float(ys[-1]) if ys else -1.0
            t = r["arrival_time"]
            r["arrival_hour"], r["arrival_weekday"] = t.hour, t.weekday()
            r["is_weekend"] = t.weekday() in (5, 6)
            xs.append(r["arrival_to_pickup_time"])
            ys.append(r["one_day_pickup"])
            out.append(r)
    return out
