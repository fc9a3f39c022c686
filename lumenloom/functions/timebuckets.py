"""Calendar buckets, all in UTC and half-open [start, end)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = {"HOURLY": "hour", "DAILY": "day", "MONTHLY": "month"}


def unit_of(granularity: str) -> str:
    if granularity not in UNITS:
        raise ValueError(f"granularity must be one of {sorted(UNITS)}, not {granularity!r}")
    return UNITS[granularity]


def step_of(granularity: str) -> Column:
    return F.expr(f"interval 1 {unit_of(granularity)}")


def parse_time(c: Column) -> Column:
    """A date, a timestamp with offset or a local timestamp (read as UTC); else null."""
    return F.try_to_timestamp(c)


def floor_to(c: Column, granularity: str) -> Column:
    return F.date_trunc(unit_of(granularity), c)


def ceil_to(c: Column, granularity: str) -> Column:
    floored = floor_to(c, granularity)
    return F.when(floored == c, floored).otherwise(floored + step_of(granularity))


def bucket_starts(start: Column, end: Column, granularity: str) -> Column:
    """Starts of all buckets that touch [start, end); a point inside a bucket touches it."""
    first = floor_to(start, granularity)
    last = floor_to(end - F.expr("interval 1 microsecond"), granularity)
    starts = F.sequence(first, F.greatest(first, last), step_of(granularity))
    return F.when(last >= first, starts).otherwise(F.slice(starts, 1, 0))


def bucket_end(start: Column, granularity: str) -> Column:
    return start + step_of(granularity)


def seconds_between(start: Column, end: Column) -> Column:
    return F.unix_seconds(end) - F.unix_seconds(start)


def billing_month(c: Column) -> tuple[Column, Column]:
    start = F.date_trunc("month", c)
    return start, start + F.expr("interval 1 month")


def millis_to_text(c: Column) -> Column:
    return F.date_format(F.timestamp_millis(c), "yyyy-MM-dd HH:mm:ss.SSS")


def path_tokens(ts: Column) -> dict[str, Column]:
    """The {year} {month} {day} {hour} parts of a delivery path."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
        "hour": F.date_format(ts, "HH"),
    }
