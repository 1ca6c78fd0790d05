"""Datetime helpers: parsing, durations in hours and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# English month abbreviations, January first.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

# Accepted text layouts beyond ISO-8601, each rewritten into ISO text and then cast
# (no exception-driven parsing, no session time zone):
#   MM/dd/yyyy[ HH:mm[:ss]]   and   dd-MMM-yyyy[ HH:mm[:ss]]
_US = r"^(\d{2})/(\d{2})/(\d{4})((?: \d{2}:\d{2}(?::\d{2})?)?)$"
_DMY = r"^(\d{2})-([A-Za-z]{3})-(\d{4})((?: \d{2}:\d{2}(?::\d{2})?)?)$"


def _month_number(abbr: Column) -> Column:
    m = F.create_map(*[x for i, name in enumerate(MONTHS) for x in (F.lit(name), F.lit(f"{i + 1:02d}"))])
    return m[F.upper(abbr)]


def coerce_timestamp(c: Column, dtype: T.DataType | None = None, strict: bool = False) -> Column:
    """Anything -> zone-less timestamp; unparsable -> NULL (``strict``: an error). Idempotent.

    ISO-8601 text (``2024-01-02``, ``2024-01-02 03:04:05[.ffffff]``, ``T`` separator)
    is cast directly; ``MM/dd/yyyy[ HH:mm[:ss]]`` and ``dd-MMM-yyyy[ HH:mm[:ss]]`` are
    reordered into ISO text first. The first layout that yields a timestamp wins.
    """
    if isinstance(dtype, T.TimestampNTZType):
        return c
    if isinstance(dtype, (T.TimestampType, T.DateType)):
        return c.cast("timestamp_ntz")
    s = F.trim(c.cast("string"))
    us = F.when(s.rlike(_US), F.regexp_replace(s, _US, "$3-$1-$2$4"))
    dmy = F.when(s.rlike(_DMY), F.concat(F.regexp_extract(s, _DMY, 3), F.lit("-"),
                                         _month_number(F.regexp_extract(s, _DMY, 2)), F.lit("-"),
                                         F.regexp_extract(s, _DMY, 1), F.regexp_extract(s, _DMY, 4)))
    out = F.coalesce(s.try_cast("timestamp_ntz"), us.try_cast("timestamp_ntz"), dmy.try_cast("timestamp_ntz"))
    if strict:
        out = F.when(s.isNull() | out.isNotNull(), out).otherwise(
            F.raise_error(F.concat(F.lit("cannot parse as a timestamp: "), s)))
    return out


def micros_since_epoch(ts: Column) -> Column:
    """Microseconds from 1970-01-01 00:00 to a zone-less timestamp (wall clock, no zone)."""
    return _interval_micros(ts - F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _interval_micros(d: Column) -> Column:
    return (F.extract(F.lit("DAY"), d).cast("bigint") * F.lit(86_400_000_000)
            + F.extract(F.lit("HOUR"), d).cast("bigint") * F.lit(3_600_000_000)
            + F.extract(F.lit("MINUTE"), d).cast("bigint") * F.lit(60_000_000)
            + (F.extract(F.lit("SECOND"), d) * F.lit(1_000_000)).cast("bigint"))


def hours_between(start: Column, end: Column) -> Column:
    """``(end - start)`` in fractional hours, exact to the microsecond (NULL if either is NULL).

    Computed from the day-time interval ``end - start``, which for zone-less
    timestamps is plain wall-clock arithmetic: the session time zone (and its
    daylight-saving shifts) never enters.
    """
    return _interval_micros(end - start) / F.lit(3.6e9)


def day_name(ts: Column) -> Column:
    """Full English day name, e.g. ``Saturday``."""
    return F.date_format(ts, "EEEE")

