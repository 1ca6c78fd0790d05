"""DuckDB twin of the cleaning job over the inputs that :mod:`inputs` derives from the tables."""

from __future__ import annotations

# The one-hot categories of the derived manifest (the first of each is dropped).
CATEGORIES = {
    "empty_full_code": ["E", "F"],
    "trade_route": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "pds_code": ["P1", "P2", "Unknown"],
    "plan_equip_type_code": ["D20", "D40", "R40"],
}

_DUMMIES = ",\n    ".join(f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v}" for c, vs in CATEGORIES.items() for v in vs[1:])


def _hours(a: str, b: str) -> str:
    return f"date_diff('microsecond', {a}, {b}) / 3.6e9"


# One row per surviving key, before the history features (step a to the last row per key).
CLEANED_SQL = f"""
  lines AS (
    SELECT l.*, o_orderdate, unnest(types) AS event_type, unnest(range(len(types))) AS e_place
    FROM (SELECT *, CASE l_linenumber WHEN 1 THEN ['AVP', 'DFV'] WHEN 2 THEN ['OGT', 'AVP'] WHEN 3 THEN ['DFV', 'OGT']
                    WHEN 4 THEN ['HLP', 'DFV'] WHEN 5 THEN ['LTV', 'AVP'] WHEN 6 THEN ['OGT', 'AVP']
                    WHEN 7 THEN ['HLP', 'OGT'] ELSE ['HLP'] END AS types FROM lineitem) l
    LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey),
  ev AS (
    SELECT l_orderkey AS ok,
           row(l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice, l_discount,
               l_tax, l_returnflag, l_linestatus, e_place) AS ord, event_type,
           CASE event_type WHEN 'AVP' THEN 2 WHEN 'OGT' THEN 2 + CAST(trunc(l_quantity) AS INTEGER) WHEN 'DFV' THEN 1
                           WHEN 'LTV' THEN -24 ELSE 5 END AS hours,
           l_returnflag = 'R' AND l_linenumber = 5 AS raw, l_shipdate, o_orderdate,
           'STE' || CAST(l_suppkey % 3 AS VARCHAR) AS inventory_location_code
    FROM lines),
  ed AS (
    SELECT ok, ord, event_type, inventory_location_code,
           date_trunc('second', CAST(CASE WHEN raw THEN l_shipdate ELSE o_orderdate + to_hours(hours) END AS TIMESTAMP)) AS event_date
    FROM ev),
  sched AS (
    SELECT o_custkey % 5 AS vessel, year(o_orderdate) * 100 + week(o_orderdate) AS voyage,
           date_trunc('second', CAST(min(o_orderdate) AS TIMESTAMP)) AS arrival_time FROM orders GROUP BY 1, 2),
  mf AS (
    SELECT o_orderkey AS ok, o_custkey % 5 AS vessel, year(o_orderdate) * 100 + week(o_orderdate) AS next_voyage,
           CASE WHEN o_orderpriority < '4' THEN 'E' ELSE 'W' END AS direction_seq, c_name AS consignee_name,
           o_orderpriority AS shipper_name, o_orderstatus AS carrier_code,
           date_trunc('second', CAST(o_orderdate - INTERVAL 10 DAY AS TIMESTAMP)) AS sail_date,
           CASE WHEN o_orderkey % 11 = 0 THEN 'H1' ELSE 'Unknown' END AS hazard_type_code,
           CASE WHEN o_orderkey % 13 = 0 THEN 'D2' ELSE 'Unknown' END AS current_damage_code,
           CASE WHEN o_orderkey % 2 = 0 THEN '9''6' ELSE 'Unkown' END AS equipment_type_height_code,
           CASE WHEN o_orderkey % 7 <> 0 THEN 'GENERAL' ELSE 'Unkown' END AS commodity,
           CASE WHEN o_orderkey % 5 = 0 THEN 'ACTIVE' ELSE 'Unknown' END AS life_cycle_status_code,
           CASE o_orderkey % 3 WHEN 0 THEN 'P1' WHEN 1 THEN 'P2' ELSE 'Unknown' END AS pds_code,
           CASE WHEN o_orderkey % 17 <> 0 THEN 'SHA' ELSE 'Unknown' END AS discharge_port_code,
           CASE WHEN o_totalprice > 100000 THEN 'F' ELSE 'E' END AS empty_full_code, c_mktsegment AS trade_route,
           CASE o_orderkey % 4 WHEN 0 THEN 'D40' WHEN 1 THEN 'D20' ELSE 'R40' END AS plan_equip_type_code
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey),
  per_key AS (
    SELECT ok, count(*) FILTER (WHERE event_type = 'HLP') AS hlp_count,
           arg_min(event_date, ord) FILTER (WHERE event_type = 'OGT' AND inventory_location_code IN ('STE1', 'STE2')
                                            AND event_date IS NOT NULL) AS pickup_date,
           arg_min(event_date, ord) FILTER (WHERE event_type = 'AVP' AND event_date IS NOT NULL) AS avp_date,
           max(event_date) FILTER (WHERE event_type = 'DFV') AS dfv_event_date,
           max(event_date) FILTER (WHERE event_type = 'LTV') AS load_date
    FROM ed GROUP BY ok),
  firsts AS (SELECT ok, event_type, event_date, inventory_location_code, min(ord) AS ord FROM ed GROUP BY 1, 2, 3, 4),
  lasts AS (SELECT * FROM firsts QUALIFY row_number() OVER (PARTITION BY ok ORDER BY ord DESC) = 1),
  durations AS (
    SELECT p.*, m.* EXCLUDE (ok), s.arrival_time, x.event_type, x.event_date, x.inventory_location_code,
           {_hours('avp_date', 'pickup_date')} AS storage_time, {_hours('arrival_time', 'avp_date')} AS time_til_avp,
           {_hours('arrival_time', 'dfv_event_date')} AS time_to_unload,
           {_hours('arrival_time', 'pickup_date')} AS arrival_to_pickup_time,
           {_hours('arrival_time', 'avp_date')} - {_hours('arrival_time', 'dfv_event_date')} AS port_to_ste_time,
           {_hours('sail_date', 'avp_date')} AS journey_length
    FROM per_key p JOIN lasts x USING (ok) JOIN mf m USING (ok)
    LEFT JOIN sched s ON s.vessel = m.vessel AND s.voyage = m.next_voyage AND m.direction_seq = 'E'),
  cleaned AS (
    SELECT 'EQ' || CAST(ok AS VARCHAR) || '_' || CAST(ok AS VARCHAR) AS key, 'EQ' || CAST(ok AS VARCHAR) AS equipment_id,
           ok AS booking_number, event_type, event_date, inventory_location_code, 'V' || CAST(vessel AS VARCHAR) AS vessel_code,
           CAST(next_voyage - 1 AS DOUBLE) AS voyage, direction_seq, consignee_name, shipper_name, carrier_code, sail_date,
           hazard_type_code, current_damage_code, equipment_type_height_code, commodity, life_cycle_status_code,
           discharge_port_code, next_voyage,
           'V' || CAST(vessel AS VARCHAR) || '_' || CAST(next_voyage AS VARCHAR) || '_' || direction_seq AS voyage_code,
           arrival_time, hlp_count, pickup_date, avp_date, dfv_event_date, load_date, storage_time, time_til_avp,
           time_to_unload, arrival_to_pickup_time, port_to_ste_time, dayname(avp_date) AS avp_day_of_week,
           CAST(arrival_to_pickup_time < 24 AS INTEGER) AS one_day_pickup, journey_length,
    {_DUMMIES}
    FROM durations
    WHERE port_to_ste_time >= 0 AND arrival_to_pickup_time >= 0 AND time_to_unload >= 0 AND time_til_avp >= 0
      AND storage_time >= 0 AND consignee_name IS NOT NULL AND shipper_name IS NOT NULL AND carrier_code IS NOT NULL)
"""

_W = "PARTITION BY consignee_name ORDER BY arrival_time, booking_number"

CLEAN_CONTAINER_SQL = f"""
WITH {CLEANED_SQL},
  lists AS (SELECT *, list(arrival_to_pickup_time) OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS xs FROM cleaned)
SELECT * EXCLUDE (xs, voyage, storage_time, time_til_avp, time_to_unload, arrival_to_pickup_time, port_to_ste_time, journey_length),
  round(voyage, 4) AS voyage, round(storage_time, 4) AS storage_time, round(time_til_avp, 4) AS time_til_avp,
  round(time_to_unload, 4) AS time_to_unload, round(arrival_to_pickup_time, 4) AS arrival_to_pickup_time,
  round(port_to_ste_time, 4) AS port_to_ste_time, round(journey_length, 4) AS journey_length,
  CAST(row_number() OVER w - 1 AS BIGINT) AS consignee_history_count,
  (row_number() OVER w - 1) < 5 AS low_history_flag,
  round(coalesce(avg(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_avg_pickup,
  round(coalesce(stddev_samp(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_std_pickup,
  round(coalesce(median(arrival_to_pickup_time) OVER p, -1), 4) AS lifetime_median_pickup,
  round(coalesce(CASE WHEN count(arrival_to_pickup_time) OVER r5 = 5
                      THEN avg(arrival_to_pickup_time) OVER r5 END, -1), 4) AS recent_5_avg_pickup,
  round(coalesce(CASE WHEN count(arrival_to_pickup_time) OVER r10 = 10
                      THEN avg(arrival_to_pickup_time) OVER r10 END, -1), 4) AS recent_10_avg_pickup,
  round(coalesce(list_sum(list_transform(xs, lambda v, i: v * pow(0.9, len(xs) - i)))
    / nullif(list_sum(list_transform(xs, lambda v, i: pow(0.9, len(xs) - i))), 0), -1), 4) AS weighted_avg_pickup,
  round(coalesce(CASE WHEN count(one_day_pickup) OVER r5 = 5 THEN avg(one_day_pickup) OVER r5 END, -1), 4) AS recent_5_24h_rate,
  round(coalesce(CAST(lag(one_day_pickup) OVER w AS DOUBLE), -1), 4) AS last_one_day_pickup,
  CAST(hour(arrival_time) AS INTEGER) AS arrival_hour,
  CAST(isodow(arrival_time) - 1 AS INTEGER) AS arrival_weekday,
  isodow(arrival_time) IN (6, 7) AS is_weekend
FROM lists
WINDOW w AS ({_W}),
       p AS ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
       r5 AS ({_W} ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING),
       r10 AS ({_W} ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING)
"""

UPLOAD_SCORE_SQL = f"""
WITH {CLEANED_SQL}
SELECT equipment_id, booking_number, consignee_name, voyage_code,
       round(0.5 * one_day_pickup + least(greatest(arrival_to_pickup_time, 0), 240) / 480.0, 4) AS stowage_priority
FROM cleaned
"""
