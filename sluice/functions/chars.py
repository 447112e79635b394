"""CHAR(n) and VARCHAR(n) columns as plain text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.columns import column

# Fixed value: where Spark notes that a text column is CHAR(n) or VARCHAR(n).
CHAR_MARK = "__CHAR_VARCHAR_TYPE_STRING"


def read_as_text(spark: SparkSession, read: Callable[[SparkSession], DataFrame]) -> DataFrame:
    """What ``read`` gives, with text columns as the source has them and without length marks.

    Spark pads CHAR columns to their full length by a function around the column, and filters
    on it then no longer reach the source. Where it would, a session without padding reads.
    """
    df = read(spark)
    if _pads_chars(df):
        df = read(_unpadded(spark))
    marked = [field.name for field in df.schema if CHAR_MARK in field.metadata]
    if not marked:
        return df
    return df.withColumns({name: column(name).alias(name, metadata={}) for name in marked})


def _pads_chars(df: DataFrame) -> bool:
    padding = df.sparkSession.conf.get("spark.sql.readSideCharPadding")
    marks = [field.metadata.get(CHAR_MARK, "") for field in df.schema]
    return padding.lower() == "true" and any(mark.startswith("char") for mark in marks)


def _unpadded(spark: SparkSession) -> SparkSession:
    """A session with the same settings that leaves CHAR values alone."""
    return with_settings(spark, {"spark.sql.readSideCharPadding": "false"})


def with_settings(spark: SparkSession, other: dict[str, str]) -> SparkSession:
    """A session with the same settings but for the given ones."""
    session = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(name) or not name.startswith("spark."):  # the latter are Hadoop's
            session.conf.set(name, value)
    for name, value in other.items():
        session.conf.set(name, value)
    return session
