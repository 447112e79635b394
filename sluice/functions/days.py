"""Day arithmetic: in Python for the run's own day, as columns for data."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the format in which days are compared and written.
DAY_FORMAT = "yyyy-MM-dd"


def to_day(value: date | datetime | str) -> date:
    """A date from a date, a datetime or an ISO string."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value.strip())


def run_day(as_of: date | datetime | str | None = None) -> date:
    """``as_of``, or today in UTC. Giving it makes a daily run repeatable."""
    return datetime.now(timezone.utc).date() if as_of is None else to_day(as_of)


def previous_day(as_of: date | datetime | str | None = None) -> date:
    """The day before ``as_of``; without it, the day before today in UTC."""
    return run_day(as_of) - timedelta(days=1)


def previous_day_of(column: Column) -> Column:
    return F.date_sub(F.to_date(column), 1)


def format_day(column: Column) -> Column:
    return F.date_format(column, DAY_FORMAT)


def parse_day(column: Column) -> Column:
    return F.to_date(column, DAY_FORMAT)
