"""Time helpers. "Now" is always the caller's `as_of`, never the wall clock, so reruns agree."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AsOf = dt.datetime | dt.date | str | Column

#: units accepted wherever a date part is named
DATE_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


def as_of_column(as_of: AsOf, like: str = "timestamp_ntz") -> Column:
    """A point in time as a column. Python times go in as text, since a datetime literal would pass
    through the zone of this machine; one with an offset is taken in UTC."""
    if isinstance(as_of, Column):
        return as_of.cast(like)
    if isinstance(as_of, dt.datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.lit(as_of if isinstance(as_of, str) else as_of.isoformat()).cast(like)


def check_datepart(datepart: str) -> str:
    if datepart not in DATE_PARTS:
        raise ValueError(f"datepart must be one of {DATE_PARTS}, got {datepart!r}")
    return datepart


def shift(ts: Column, datepart: str, amount: int | Column) -> Column:
    """`ts` moved by `amount` date parts (negative moves back)."""
    return F.timestamp_add(check_datepart(datepart).upper(), F.lit(amount).cast("int"), ts)


def within_lookback(ts: Column | str, as_of: AsOf, amount: int, datepart: str = "day") -> Column:
    """Rows not older than `amount` date parts before `as_of`, and not later than `as_of`: a replay on a
    table that has grown since gives the same rows."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    now = as_of_column(as_of)
    return (ts >= shift(now, datepart, -amount)) & (ts <= now)


#: what the timestamp type can hold; no smaller number is taken for a mistake
MOST_SECONDS = 9.2e12


def event_time(raw: Column | str) -> Column:
    """Event time from text: ISO-8601, or a number of seconds; anything else is the epoch.

    Text without an offset is read in the session zone, which the jobs pin to UTC.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    seconds = raw.try_cast("double")
    # A bare number also parses as an ISO year, so the numeric reading is tried first.
    from_number = F.when(F.abs(seconds) <= MOST_SECONDS, F.timestamp_micros(F.floor(seconds * 1000) * 1000))
    return F.coalesce(from_number, F.try_to_timestamp(raw), F.timestamp_seconds(F.lit(0)))


def truncated(df: DataFrame, datepart: str, column: str = "timestamp") -> Column:
    """Start of the date part, in the column's own timestamp type."""
    return F.date_trunc(datepart, column).cast(df.schema[column].dataType)


def date_parts(df: DataFrame, column: str = "timestamp", prefix: str = "txn") -> list[Column]:
    """Day, hour, day of week (Sunday = 0) and hour of day."""
    return [
        truncated(df, "day", column).alias(f"{prefix}_date"),
        truncated(df, "hour", column).alias(f"{prefix}_hour"),
        (F.dayofweek(column) - 1).alias("day_of_week"),
        F.hour(column).alias("hour_of_day"),
    ]
