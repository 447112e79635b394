"""Counting what a run writes, and the check value to continue from.

Both come from an ``Observation`` on the rows on their way to the target: one pass, and
no second read of the source or the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, TimestampType

from sluice.functions.columns import column, require_field


def observe_progress(
    df: DataFrame, check_column: str | None = None, *more: Column
) -> tuple[DataFrame, Observation]:
    """``df`` with its row count and highest check value being observed, and ``more`` named sums.

    Put it right below the write. There it runs in the tasks that write the files, and Spark
    counts each of those once; in a stage before a shuffle, tasks repeated after the loss of
    an executor would count again.
    """
    observation = Observation()
    metrics = [F.count(F.lit(1)).alias("rows")]
    if check_column:
        metrics.append(_highest(df, check_column).alias("last_value"))
    return df.observe(observation, *metrics, *more), observation


def read_progress(observation: Observation) -> tuple[int, str | None]:
    """Row count and highest check value, as text, once the write is over."""
    seen = observation.get
    return int(seen["rows"]), seen.get("last_value")


def highest_mark(df: DataFrame, check_column: str) -> str | None:
    """The highest check value of these rows. Spark's JDBC reader has no aggregates handed over: of a
    database, give the row in which it says its highest value, not the table."""
    return df.agg(_highest(df, check_column).alias("last_value")).first()[0]


def _highest(df: DataFrame, check_column: str) -> Column:
    """The highest check value as text that a typed literal reads back exactly."""
    field = require_field(df, check_column, "check column")
    value = column(field.name)
    if isinstance(field.dataType, (DoubleType, FloatType)):
        value = F.when(~F.isnan(value), value)  # nothing comes behind NaN
    highest = F.max(value)
    if isinstance(field.dataType, TimestampType):
        # With its offset, so that neither another zone nor a repeated hour changes it.
        return F.date_format(highest, "yyyy-MM-dd HH:mm:ss.SSSSSSxxx")
    if isinstance(field.dataType, StringType):
        return F.concat(F.lit("'"), highest, F.lit("'"))  # one pair of quotes is dropped
    return highest.cast("string")
