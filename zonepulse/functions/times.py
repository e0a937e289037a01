"""Timestamps and calendar parts. Everything is UTC wall time without a zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonepulse.functions import fixed
from zonepulse.functions.scalars import as_col, lookup

HOUR = "interval 1 hour"


def shift_days(ts, days: int) -> Column:
    """Timestamp moved by whole days. The number of days has no default on purpose."""
    return as_col(ts) + F.make_dt_interval(days=F.lit(days))


def shift_years(day, years: int) -> Column:
    """Date moved by calendar years; 29 February lands on 28 February."""
    return F.add_months(as_col(day), 12 * years)


def ago(as_of, interval: str) -> Column:
    """`as_of` minus an interval such as '24 hours'."""
    return as_col_or_stamp(as_of) - F.expr(f"interval {interval}")


def as_col_or_stamp(value) -> Column:
    """Columns stay; texts and datetimes become timestamp literals."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp_ntz")


def stamp(as_of=None) -> Column:
    """Processing time, or the given time for repeatable runs."""
    return F.current_timestamp() if as_of is None else as_col_or_stamp(as_of)


def hour_floor(ts) -> Column:
    return F.date_trunc("hour", as_col(ts)).cast("timestamp_ntz")


def day_of(ts) -> Column:
    return F.to_date(as_col(ts))


def seconds_between(start, end) -> Column:
    """Complete seconds from start to end, truncated toward zero."""
    return F.timestamp_diff("SECOND", as_col(start), as_col(end))


def days_between(start, end) -> Column:
    return F.datediff(as_col(end), as_col(start)).cast("long")


def dow(ts) -> Column:
    """1 = Sunday .. 7 = Saturday."""
    return F.dayofweek(as_col(ts))


def is_weekend(ts) -> Column:
    return dow(ts).isin(1, 7)


def date_id(day) -> Column:
    return F.date_format(as_col(day), "yyyyMMdd")


def month_key(ts) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM")


def day_name(ts) -> Column:
    return F.date_format(as_col(ts), "EEEE")


def dow_name(number) -> Column:
    return lookup(as_col(number).cast("int"), dict(enumerate(fixed.DAY_NAMES, start=1)))


def from_epoch(seconds) -> Column:
    return F.timestamp_seconds(as_col(seconds)).cast("timestamp_ntz")


def calendar_parts(day) -> dict[str, Column]:
    day = as_col(day)
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "day_of_week": dow(day),
        "day_of_year": F.dayofyear(day),
        "quarter": F.quarter(day),
    }
