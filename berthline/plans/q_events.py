"""Registered per-key event queries (A1-A5, D1-D6, K6, K9) over the ``events`` table.

Role mapping: key = ``user_id``, row order = ``event_id``, date = ``ts``;
pickup = ``purchase`` (at a "location" ``value >= 10``), AVP = ``view``,
HLP = ``error``, DFV = ``click``, LTV = ``signup``, arrival = the key's first event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.columns import add_day_of_week, add_time_parts
from ..operators.events import (EventStat, add_load_date, add_pickup_date, add_stage_durations, add_time_to_unload_feature,
                                calculate_journey_length, calculate_storage_time, count_hlp_occurrences, event_pivot)
from ..operators.ordering import with_order
from .registry import register
from .tables import SHIPMENTS_SQL, rounded, shipments, table



def _pickup():
    return (F.col("event_type") == "purchase") & (F.col("value") >= 10)

PICKUP_SQL = "event_type = 'purchase' AND value >= 10"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_order(table(spark, sf_dir, "events"), "event_id")


@register("time_parts", """
SELECT event_id, ts, dayname(ts) AS avp_day_of_week, CAST(hour(ts) AS INTEGER) AS arrival_hour,
       CAST(isodow(ts) - 1 AS INTEGER) AS arrival_weekday, isodow(ts) IN (6, 7) AS is_weekend
FROM events
""")
def q_time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "ts")
    return add_time_parts(add_day_of_week(e, "ts"), "ts")


@register("event_count_by_key", """
SELECT event_id, user_id,
       CAST(count(*) FILTER (WHERE event_type = 'error') OVER (PARTITION BY user_id) AS BIGINT) AS hlp_count
FROM events
""")
def q_event_count_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = count_hlp_occurrences(_events(spark, sf_dir), key="user_id", event_type="error")
    return out.select("event_id", "user_id", "hlp_count")


@register("event_first_by_key", f"""
SELECT event_id, user_id,
  arg_min(ts, event_id) FILTER (WHERE {PICKUP_SQL} AND ts IS NOT NULL) OVER k AS pickup_date,
  arg_min(ts, event_id) FILTER (WHERE event_type = 'view' AND ts IS NOT NULL) OVER k AS avp_date
FROM events WINDOW k AS (PARTITION BY user_id)
""")
def q_event_first_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    out = event_pivot(e, "user_id", [EventStat("pickup_date", _pickup(), "first", "ts"),
                                     EventStat("avp_date", F.col("event_type") == "view", "first", "ts")])
    return out.select("event_id", "user_id", "pickup_date", "avp_date")


@register("event_latest_by_key", """
SELECT event_id, user_id,
  max(ts) FILTER (WHERE event_type = 'click') OVER k AS dfv_event_date,
  max(ts) FILTER (WHERE event_type = 'signup') OVER k AS load_date
FROM events WINDOW k AS (PARTITION BY user_id)
""")
def q_event_latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    out = event_pivot(e, "user_id", [EventStat("dfv_event_date", F.col("event_type") == "click", "max", "ts"),
                                     EventStat("load_date", F.col("event_type") == "signup", "max", "ts")])
    return out.select("event_id", "user_id", "dfv_event_date", "load_date")


@register("stage_durations", f"""
WITH k AS (
  SELECT user_id,
    min(ts) AS arrival_time,
    arg_min(ts, event_id) FILTER (WHERE {PICKUP_SQL} AND ts IS NOT NULL) AS pickup_date,
    arg_min(ts, event_id) FILTER (WHERE event_type = 'view' AND ts IS NOT NULL) AS avp_date,
    max(ts) FILTER (WHERE event_type = 'click') AS dfv_event_date
  FROM events GROUP BY user_id),
d AS (
  SELECT user_id,
    date_diff('microsecond', avp_date, pickup_date) / 3.6e9 AS storage_time,
    date_diff('microsecond', arrival_time, avp_date) / 3.6e9 AS time_til_avp,
    date_diff('microsecond', arrival_time, dfv_event_date) / 3.6e9 AS time_to_unload,
    date_diff('microsecond', arrival_time, pickup_date) / 3.6e9 AS arrival_to_pickup_time
  FROM k)
SELECT e.event_id, e.user_id, round(storage_time, 4) AS storage_time, round(time_til_avp, 4) AS time_til_avp,
  round(time_to_unload, 4) AS time_to_unload, round(arrival_to_pickup_time, 4) AS arrival_to_pickup_time,
  round(time_til_avp - time_to_unload, 4) AS port_to_ste_time
FROM events e JOIN d USING (user_id)
""")
def q_stage_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _events(spark, sf_dir)
    ev = F.col("event_type")
    out = event_pivot(e, "user_id", [
        EventStat("arrival_time", F.lit(True), "min", "ts"),
        EventStat("pickup_date", _pickup(), "first", "ts"),
        EventStat("avp_date", ev == "view", "first", "ts"),
        EventStat("dfv_event_date", ev == "click", "max", "ts"),
    ])
    out = add_stage_durations(out)
    return rounded(out.select("event_id", "user_id", "storage_time", "time_til_avp", "time_to_unload",
                              "arrival_to_pickup_time", "port_to_ste_time"))


@register("journey_length", f"""
SELECT l_orderkey, l_linenumber, l_partkey, arrival_time AS sail_date, pickup_date AS avp_date,
       round(date_diff('microsecond', arrival_time, pickup_date) / 3.6e9, 4) AS journey_length
FROM ({SHIPMENTS_SQL})
""")
def q_journey_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = shipments(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_partkey",
                                        F.col("arrival_time").alias("sail_date"),
                                        F.col("pickup_date").alias("avp_date"))
    return rounded(calculate_journey_length(s))


@register("event_operators", f"""
WITH k AS (
  SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS hlp_count,
    arg_min(ts, event_id) FILTER (WHERE {PICKUP_SQL} AND ts IS NOT NULL) AS pickup_date,
    arg_min(ts, event_id) FILTER (WHERE event_type = 'view' AND ts IS NOT NULL) AS avp_date,
    max(ts) FILTER (WHERE event_type = 'click') AS dfv_event_date, max(ts) FILTER (WHERE event_type = 'signup') AS load_date
  FROM events GROUP BY user_id)
SELECT e.event_id, e.user_id, hlp_count, pickup_date, avp_date, dfv_event_date, load_date,
  round(date_diff('microsecond', avp_date, pickup_date) / 3.6e9, 4) AS storage_time,
  round(date_diff('microsecond', e.ts, dfv_event_date) / 3.6e9, 4) AS time_to_unload
FROM events e JOIN k USING (user_id)
""")
def q_event_operators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five single-purpose event operators one after the other (an event of value 10 or more is at a pickup yard)."""
    e = _events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts", "_ord", F.col("ts").alias("arrival_time"),
                                      F.when(F.col("value") >= 10, "STE1").otherwise("STE9").alias("yard"))
    e = count_hlp_occurrences(e, key="user_id", event_type="error")
    e = add_pickup_date(e, key="user_id", location_col="yard", event_type="purchase", date_col="ts")
    e = calculate_storage_time(e, key="user_id", event_type="view", date_col="ts")
    e = add_time_to_unload_feature(e, "user_id", event_type="click", event_date_col="ts")
    e = add_load_date(e, "user_id", event_type="signup", event_date_col="ts")
    return rounded(e.select("event_id", "user_id", "hlp_count", "pickup_date", "avp_date", "dfv_event_date", "load_date",
                            "storage_time", "time_to_unload"))
