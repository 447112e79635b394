"""Row selection of the ingestion modes.

Each filter takes and returns a DataFrame and is a plain comparison of the check column
with a literal of that column's type, so that Catalyst hands it to the database or to the
file reader. Rows whose check column is NULL are never selected.
"""

from __future__ import annotations

import warnings
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DoubleType,
    FloatType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from sluice.functions.columns import column, require_field
from sluice.functions.days import to_day
from sluice.functions.literals import typed_literal


def incremental_filter(
    df: DataFrame,
    check_column: str,
    last_value: object,
    inclusive: bool = True,
    zone: str | None = None,
) -> DataFrame:
    """Rows from ``last_value`` on, or only those behind it with ``inclusive=False``."""
    field = require_field(df, check_column, "check column")
    bound = typed_literal(df.sparkSession, last_value, field.dataType, zone)
    check = column(field.name)
    return df.filter(check >= bound if inclusive else check > bound)


def limit_filter(
    df: DataFrame, check_column: str, highest: str | None, zone: str | None = None
) -> DataFrame:
    """Rows up to a mark that was found before; none without one. NaN is above all marks and none
    itself, so its rows come always."""
    field = require_field(df, check_column, "check column")
    check, floating = column(field.name), isinstance(field.dataType, (DoubleType, FloatType))
    if highest is None:
        return df.filter(F.isnan(check)) if floating else df.limit(0)
    below = check <= typed_literal(df.sparkSession, highest, field.dataType, zone)
    return df.filter(below | F.isnan(check) if floating else below)


def daily_filter(
    df: DataFrame,
    check_column: str,
    day: date | str,
    whole_day: bool = False,
    zone: str | None = None,
) -> DataFrame:
    """Rows of one day: equal to its midnight, or anywhere within it with ``whole_day``."""
    field = require_field(df, check_column, "check column")
    check, day = column(field.name), to_day(day)
    start = day_literal(day, field.dataType, zone)
    if not whole_day:
        if isinstance(field.dataType, (TimestampType, TimestampNTZType)):
            warnings.warn(
                f"only rows at midnight are taken of '{field.name}', which has times of day;"
                " wholeDay=true takes all of the day",
                stacklevel=2,
            )
        return df.filter(check == start)
    end = day_literal(day + timedelta(days=1), field.dataType, zone)
    return df.filter((check >= start) & (check < end))


def day_literal(day: date, dtype: DataType, zone: str | None = None) -> Column:
    """The start of a day, to compare a column of this type with."""
    # Text is compared as text: a date literal would put a cast around the column, which
    # fails on the first malformed value and keeps the filter from being pushed down.
    if isinstance(dtype, StringType):
        return F.lit(day.isoformat())
    if isinstance(dtype, DateType):
        return F.lit(day)
    if isinstance(dtype, TimestampNTZType):
        return F.lit(day.isoformat()).cast(dtype)
    if isinstance(dtype, TimestampType):
        return F.lit(f"{day.isoformat()} 00:00:00 {zone or ''}".strip()).cast(dtype)
    raise ValueError(
        f"a daily run needs a date, timestamp or text check column, not {dtype.simpleString()}"
    )
