"""Typed literals from option strings.

Option values are text. Turned into a literal of the column's own type they reach the
source as a plain comparison, which Spark's readers can push down, and they cannot carry
SQL of their own.
"""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DateType,
    DecimalType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Anything but digits, colons and dots behind a time of day is a zone.
_ZONE_SUFFIX = re.compile(r"\d:\d\d(:\d\d(\.\d+)?)?\s*[^\d\s:.].*$")


def unquote(text: str) -> str:
    """Drop one pair of surrounding quotes, as found in option values written for raw SQL."""
    text = text.strip()
    if len(text) >= 2 and text[0] == text[-1] and text[0] in "'\"":
        return text[1:-1]
    return text


def typed_literal(
    spark: SparkSession, value: object, dtype: DataType, zone: str | None = None
) -> Column:
    """``value`` as a literal of ``dtype``; refuses what does not fit that type exactly.

    ``zone`` is the zone in which a timestamp without one is meant; the session's if None.
    """
    text = unquote(str(value))
    if isinstance(dtype, StringType):
        return F.lit(text)

    # One literal row: the optimizer works this out by itself, no job runs.
    given = spark.sql("SELECT text FROM VALUES (:text) AS given(text)", args={"text": text})
    # As text: Python has no years behind 9999, which plain numbers may look like.
    casts = [F.col("text").try_cast(kind).cast("string") for kind in (dtype, "timestamp_ntz")]
    as_type, as_time = given.select(*casts).collect()[0]
    if as_type is None:
        raise ValueError(f"'{text}' is not a value of type {dtype.simpleString()} by itself")

    if isinstance(dtype, DecimalType) and Decimal(text) != Decimal(as_type):
        raise ValueError(f"'{text}' does not fit {dtype.simpleString()} without rounding")
    if isinstance(dtype, DateType) and as_time != f"{as_type} 00:00:00":
        raise ValueError(f"'{text}' has a time of day, which a date column does not")
    if isinstance(dtype, TimestampNTZType) and _ZONE_SUFFIX.search(text):
        raise ValueError(f"'{text}' has a zone, which a {dtype.simpleString()} column does not")
    if isinstance(dtype, TimestampType) and zone and not _ZONE_SUFFIX.search(text):
        return F.lit(f"{as_time} {zone}").cast(dtype)
    return F.lit(text).cast(dtype)
