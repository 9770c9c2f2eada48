"""Calendar arithmetic on timestamp columns (with or without time zone)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def replace_days(ts: Column, day: int) -> Column:
    """`ts` on the given day of its month; fails if the month has no such day."""
    moved = ts + F.make_dt_interval(F.lit(day) - F.dayofmonth(ts))
    in_month = F.lit(day).between(F.lit(1), F.dayofmonth(F.last_day(ts)))
    message = F.lit(f"day {day} is out of range for month")
    return F.when(in_month | ts.isNull(), moved).otherwise(F.raise_error(message))


def adjust_months(ts: Column, months: int, shift_backwards: bool = True) -> Column:
    """`ts` moved by whole months, clamped to the end of a shorter month."""
    return ts + F.make_ym_interval(F.lit(0), F.lit(-months if shift_backwards else months))


def adjust_days(ts: Column, days: int, shift_backwards: bool = True) -> Column:
    """`ts` moved by whole days."""
    return ts + F.make_dt_interval(F.lit(-days if shift_backwards else days))


def month_aligned_window(as_of: datetime, days: int) -> tuple[datetime, datetime]:
    """First instant of the month `days` before `as_of`, and `as_of` itself."""
    start = as_of - timedelta(days=days)
    return start.replace(day=1, hour=0, minute=0, second=0, microsecond=0), as_of
