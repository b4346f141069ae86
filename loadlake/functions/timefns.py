"""Epoch, day and zone arithmetic on columns."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 24 * HOUR


def as_date(value: date | str | Column) -> Column:
    """A DATE column from a date, an ISO string or a column."""
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def iso_date(value: date | str) -> date:
    return value if isinstance(value, date) else date.fromisoformat(value)


def parse_timestamp(text: Column) -> Column:
    """String to timestamp; text that is no timestamp gives NULL."""
    return F.try_to_timestamp(text)


def from_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def day_bounds(day: Column) -> tuple[Column, Column]:
    """UTC [start, end) of a day."""
    start = F.to_timestamp(day)
    return start, start + F.expr("INTERVAL 1 DAY")


def day_start_millis(day: date | str) -> int:
    """Epoch millis of the UTC start of a day, for a filter on a stored long."""
    day = iso_date(day)
    return int(datetime(day.year, day.month, day.day, tzinfo=timezone.utc).timestamp() * 1000)


def local_day(ts: Column, zone: str) -> Column:
    """Calendar day of a UTC timestamp in ``zone``."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def hours_in_local_day(day: Column, zone: str) -> Column:
    """24, or 23 and 25 on the days the clocks change in ``zone``."""
    begin = F.to_utc_timestamp(F.to_timestamp(day), zone)
    end = F.to_utc_timestamp(F.to_timestamp(F.date_add(day, 1)), zone)
    return ((F.unix_seconds(end) - F.unix_seconds(begin)) / HOUR).cast("int")
