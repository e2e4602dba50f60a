"""Wall clocks, UTC instants and calendar attributes.

An instant is a ``timestamp_ntz`` holding UTC. Conversions take the zone from
a column, so one expression serves every city.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def _utc() -> Column:
    return F.lit("UTC")


def instant(moment: datetime) -> Column:
    """Literal UTC instant; a moment without a zone is taken as UTC."""
    if moment.tzinfo:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def time_text(value: Column) -> Column:
    """Canonical ``HH:mm:ss.SSS`` text of a time of day.

    Takes ``HH:mm:ss[.ffffff]`` text; a JDBC TIME arrives as a timestamp on
    1970-01-01 and can be passed as its text too.
    """
    clock = F.regexp_replace(value.cast("string"), r"^\d{4}-\d{2}-\d{2} ", "")
    stamp = F.concat(F.lit("1970-01-01 "), clock).cast("timestamp_ntz")
    return F.date_format(stamp, "HH:mm:ss.SSS")


def wall_clock(day: Column, time: Column) -> Column:
    """Date plus time-of-day text; null if either is null."""
    return F.concat(day.cast("string"), F.lit(" "), time).cast("timestamp_ntz")


def to_utc(wall: Column, zone: Column) -> Column:
    return F.convert_timezone(zone, _utc(), wall)


def to_local(instant: Column, zone: Column) -> Column:
    return F.convert_timezone(_utc(), zone, instant)


def local_date(instant: Column, zone: Column) -> Column:
    return F.to_date(to_local(instant, zone))


def local_hour(instant: Column, zone: Column) -> Column:
    return F.hour(to_local(instant, zone))


def utc_wall(stamp: Column) -> Column:
    """``timestamp`` -> UTC ``timestamp_ntz``, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), _utc(), stamp.cast("timestamp_ntz"))


def as_instant(wall: Column) -> Column:
    """UTC ``timestamp_ntz`` -> ``timestamp``, whatever the session zone is."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, wall))


def iso_utc(wall: Column) -> Column:
    """UTC text with six fractional digits, e.g. ``2024-03-01T00:00:00.000000+00:00``."""
    return F.concat(F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def hour_start(wall: Column) -> Column:
    """The wall clock at the start of its hour."""
    return F.timestamp_add("HOUR", F.hour(wall), F.to_date(wall).cast("timestamp_ntz"))


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5
