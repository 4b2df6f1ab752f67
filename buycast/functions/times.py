"""Time helpers."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(day) -> dt.date:
    return day if isinstance(day, dt.date) else dt.date.fromisoformat(str(day))


def to_time(col: Column) -> Column:
    """Text to timestamp; bad text raises."""
    return F.to_timestamp(col)


def to_time_or_null(col: Column) -> Column:
    """Text to timestamp; bad text becomes null."""
    return F.try_to_timestamp(col)


def start_of(day) -> Column:
    return F.lit(as_date(day)).cast("timestamp")


def up_to(col: Column, day) -> Column:
    """True up to the end of ``day``. A plain range on the column, so the scan can skip by it."""
    return col < start_of(as_date(day) + dt.timedelta(days=1))


def after(col: Column, day) -> Column:
    """True from the midnight that ends ``day``."""
    return col >= start_of(as_date(day) + dt.timedelta(days=1))


def add_months(day, n: int) -> dt.date:
    """Calendar month step that keeps the day of the month where the month has it."""
    day = as_date(day)
    years, month = divmod(day.month - 1 + n, 12)
    first = dt.date(day.year + years, month + 1, 1)
    last = (first.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)
    return first.replace(day=min(day.day, last.day))


def month_window(day):
    """First and last day of the calendar month that follows ``day``."""
    start = as_date(day) + dt.timedelta(days=1)
    return start, add_months(start, 1) - dt.timedelta(days=1)


def month_bounds(month: str):
    """First day of month ``yyyy-MM`` and of the next one."""
    first = dt.date.fromisoformat(f"{month}-01")
    return first, add_months(first, 1)


def year_month(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")


def monday_first_weekday(col: Column) -> Column:
    return F.weekday(col)


def days_since(col: Column, origin) -> Column:
    """Whole days from the midnight of ``origin``, negative before it."""
    return F.datediff(F.to_date(col), F.lit(as_date(origin)))


def days(start, end) -> Column:
    """Array of the days from ``start`` to ``end``, both included."""
    return F.sequence(F.lit(as_date(start)), F.lit(as_date(end)))
