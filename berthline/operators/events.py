"""Per-key event aggregates mapped back to every row, and journey durations.

The surveyed code computes each per-key statistic with a group-by and maps it
back onto the rows. Here all statistics of one step come from a single
``groupBy(key).agg(...)`` (partial aggregation combines hot keys map-side) that
is joined back once; AQE broadcasts the per-key table when it is small and
splits skewed partitions of the row side when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (EVENT_AVP, EVENT_DFV, EVENT_HLP, EVENT_LTV, EVENT_PICKUP,
                         PICKUP_LOCATIONS)
from ..functions.time import coerce_timestamp, hours_between
from .ordering import ORD


@dataclass(frozen=True)
class EventStat:
    """One per-key statistic: ``how`` in first | last | max | min | count over rows where ``when``."""

    name: str
    when: Column
    how: str = "first"
    value: str = "event_date"


def _agg(spec: EventStat, order: str) -> Column:
    v = F.col(spec.value)
    if spec.how == "count":
        return F.count_if(spec.when).alias(spec.name)
    if spec.how == "max":
        return F.max(F.when(spec.when, v)).alias(spec.name)
    if spec.how == "min":
        return F.min(F.when(spec.when, v)).alias(spec.name)
    hit = spec.when & v.isNotNull()
    pick = F.min_by if spec.how == "first" else F.max_by
    if spec.how not in ("first", "last"):
        raise ValueError(f"unknown statistic {spec.how!r}")
    # first non-null value in row order among matching rows
    return pick(F.when(hit, v), F.when(hit, F.col(order))).alias(spec.name)


def event_pivot(df: DataFrame, key: str | Sequence[str], specs: Sequence[EventStat], order: str = ORD) -> DataFrame:
    """Add one column per spec holding the per-key statistic, on every row of the key (one or several columns)."""
    if not specs:
        return df
    key = [key] if isinstance(key, str) else list(key)
    stats = df.groupBy(*key).agg(*[_agg(s, order) for s in specs])
    out = df.drop(*[s.name for s in specs if s.name in df.columns]).join(stats, key, "left")
    counts = {s.name: F.coalesce(F.col(s.name), F.lit(0)).cast("bigint")
              for s in specs if s.how == "count"}
    return out.withColumns(counts) if counts else out


def _date(df: DataFrame, name: str, strict: bool = False) -> Column:
    return coerce_timestamp(F.col(name), df.schema[name].dataType, strict=strict)


def count_hlp_occurrences(df: DataFrame, key: str = "key", event_col: str = "event_type",
                          event_type: str = EVENT_HLP, order: str = ORD) -> DataFrame:
    """``hlp_count`` = rows of the key with the given event type (0 if none)."""
    return event_pivot(df, key, [EventStat("hlp_count", F.col(event_col) == event_type, "count")], order)


def pickup_spec(event_col="event_type", location_col="inventory_location_code",
                event_type=EVENT_PICKUP, locations=PICKUP_LOCATIONS, date_col="event_date") -> EventStat:
    cond = (F.col(event_col) == event_type) & F.col(location_col).isin(*locations)
    return EventStat("pickup_date", cond, "first", date_col)


def avp_spec(event_col="event_type", event_type=EVENT_AVP, date_col="event_date") -> EventStat:
    return EventStat("avp_date", F.col(event_col) == event_type, "first", date_col)


def add_pickup_date(df: DataFrame, key: str = "key", order: str = ORD, **kw) -> DataFrame:
    """``pickup_date`` = first non-null date of a pickup event at a listed location."""
    return event_pivot(df, key, [pickup_spec(**kw)], order)


def add_storage_time(df: DataFrame) -> DataFrame:
    return df.withColumn("storage_time", hours_between(F.col("avp_date"), F.col("pickup_date")))


def calculate_storage_time(df: DataFrame, key: str = "key", order: str = ORD, **kw) -> DataFrame:
    """``avp_date`` = first non-null AVP date; ``storage_time`` = pickup - avp in hours."""
    return add_storage_time(event_pivot(df, key, [avp_spec(**kw)], order))


def calculate_time_til_avp(df: DataFrame, arrival_col: str = "arrival_time") -> DataFrame:
    return df.withColumn("time_til_avp", hours_between(F.col(arrival_col), F.col("avp_date")))


def add_time_to_unload_feature(df: DataFrame, key_col: str = "key", arrival_col: str = "arrival_time",
                               event_col: str = "event_type", event_type: str = EVENT_DFV,
                               event_date_col: str = "event_date", order: str = ORD) -> DataFrame:
    """``dfv_event_date`` = latest date of ``event_type``; ``time_to_unload`` = it - arrival.

    Both date columns are parsed strictly (an unparsable text value is an error).
    """
    df = df.withColumns({arrival_col: _date(df, arrival_col, True), event_date_col: _date(df, event_date_col, True)})
    df = event_pivot(df, key_col, [EventStat("dfv_event_date", F.col(event_col) == event_type,
                                             "max", event_date_col)], order)
    return _time_to_unload(df, arrival_col)


def _time_to_unload(df: DataFrame, arrival_col: str = "arrival_time") -> DataFrame:
    return df.withColumn("time_to_unload", hours_between(F.col(arrival_col), F.col("dfv_event_date")))


def arrival_to_pickup_time(df: DataFrame, arrival_col: str = "arrival_time") -> DataFrame:
    return df.withColumn("arrival_to_pickup_time", hours_between(F.col(arrival_col), F.col("pickup_date")))


def port_to_ste_time(df: DataFrame) -> DataFrame:
    return df.withColumn("port_to_ste_time", F.col("time_til_avp") - F.col("time_to_unload"))


def add_stage_durations(df: DataFrame, arrival_col: str = "arrival_time") -> DataFrame:
    """The five durations from ``pickup_date``, ``avp_date``, ``dfv_event_date`` and the arrival."""
    df = _time_to_unload(calculate_time_til_avp(add_storage_time(df), arrival_col), arrival_col)
    return port_to_ste_time(arrival_to_pickup_time(df, arrival_col))


def add_load_date(df: DataFrame, key_col: str | Sequence[str] = "key", event_col: str = "event_type",
                  event_type: str = EVENT_LTV, event_date_col: str = "event_date",
                  order: str = ORD) -> DataFrame:
    """``load_date`` = latest date of ``event_type`` (lift to vessel) per key (strict parsing)."""
    df = df.withColumn(event_date_col, _date(df, event_date_col, True))
    return event_pivot(df, key_col, [EventStat("load_date", F.col(event_col) == event_type,
                                               "max", event_date_col)], order)


def calculate_journey_length(df: DataFrame, start: str = "sail_date", end: str = "avp_date",
                             new_col: str = "journey_length") -> DataFrame:
    """``journey_length`` = end - start in hours, both coerced to timestamps first."""
    df = df.withColumns({start: _date(df, start), end: _date(df, end)})
    return df.withColumn(new_col, hours_between(F.col(start), F.col(end)))


def key_event_features(df: DataFrame, key: str | Sequence[str] = "key", order: str = ORD,
                       event_col: str = "event_type", date_col: str = "event_date",
                       location_col: str = "inventory_location_code",
                       arrival_col: str = "arrival_time", with_load_date: bool = False) -> DataFrame:
    """All pre-filter per-key features of the cleaning job in one aggregate and one join.

    hlp_count, pickup_date, avp_date, storage_time, time_til_avp, avp_day_of_week,
    dfv_event_date, time_to_unload, arrival_to_pickup_time, port_to_ste_time
    (and ``load_date`` with ``with_load_date``, valid when the later filter keeps
    or drops whole keys).
    """
    df = df.withColumns({date_col: _date(df, date_col), arrival_col: _date(df, arrival_col)})
    ev = F.col(event_col)
    specs = [
        EventStat("hlp_count", ev == EVENT_HLP, "count", date_col),
        pickup_spec(event_col, location_col, date_col=date_col),
        avp_spec(event_col, date_col=date_col),
        EventStat("dfv_event_date", ev == EVENT_DFV, "max", date_col),
    ]
    if with_load_date:
        specs.append(EventStat("load_date", ev == EVENT_LTV, "max", date_col))
    df = event_pivot(df, key, specs, order)
    return add_stage_durations(df, arrival_col).withColumn("avp_day_of_week", F.date_format(F.col("avp_date"), "EEEE"))
