"""Date column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_lenient(c: Column, fmt: str) -> Column:
    """Date by format; an unreadable text becomes null."""
    return F.try_to_timestamp(c, F.lit(fmt)).cast("date")


def round_to_day(ts: Column) -> Column:
    """Nearest day; the 16:00 slot belongs to the next day. 12:00 goes up."""
    return (ts.cast("timestamp_ntz") + F.expr("INTERVAL 12 HOURS")).cast("date")


def slot_of_day(ts: Column) -> Column:
    """Start of the 8-hour slot (00, 08 or 16 h) a time falls in."""
    hours = (F.floor(F.hour(ts) / 8) * 8).cast("int")
    return F.date_trunc("day", ts).cast("timestamp_ntz") + F.make_dt_interval(hours=hours)


def week_of_month(d: Column) -> Column:
    """floor(day / 7) + 1, the last days counted with week 4."""
    return F.least(F.floor(F.dayofmonth(d) / 7) + 1, F.lit(4)).cast("bigint")


def is_weekend(d: Column) -> Column:
    """Weekend in the sense of the city reports: Friday to Sunday."""
    return F.weekday(d) >= 4


def week_end(d: Column) -> Column:
    """Sunday that closes the week of a date."""
    return F.date_add(F.date_trunc("week", d).cast("date"), 6)


def window_edge(d: Column, start: Column, last: Column, days: int) -> Column:
    """First of the edges start, start + days, … that is not before a date, capped at the last date."""
    k = F.ceil(F.datediff(d, start) / days)
    return F.least(F.date_add(start, (k * days).cast("int")), last)


def wall_clock_instant(ts: Column) -> Column:
    """A local time as the instant with the same clock reading in UTC.

    Event-time windows are laid out in UTC, watermarks need an instant; this keeps both
    independent of the session's time zone.
    """
    seconds = F.unix_date(ts.cast("date")) * F.lit(86400).cast("bigint") + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.timestamp_seconds(seconds)
