"""Reading a table job's rows from its source endpoint."""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import DoubleType, FloatType

from sluice.functions.columns import require_field
from sluice.functions.days import previous_day
from sluice.functions.literals import typed_literal
from sluice.operators.filters import daily_filter, day_literal, incremental_filter
from sluice.operators.progress import highest_mark
from sluice.plans.specs import DAILY, INCREMENTALLY, Endpoint, TableJob
from sluice.sources import files, jdbc
from sluice.sources.splits import clock_zone

__all__ = ["check_source", "highest_value", "read_source", "read_table", "source_zone"]


def check_source(source: Endpoint) -> None:
    (files if files.is_files(source) else jdbc).check_endpoint(source)


def source_zone(spark: SparkSession, source: Endpoint) -> str | None:
    """The zone in which the source's timestamps without a zone become instants."""
    return None if files.is_files(source) else clock_zone(spark)


def read_source(
    spark: SparkSession, source: Endpoint, job: TableJob, mode: str, as_of: date | str | None = None
) -> DataFrame:
    """All rows of the table, before the mode's filter."""
    if files.is_files(source):
        return files.read_files(spark, source, job)

    def rows_of_mode(df: DataFrame) -> DataFrame:
        return select_rows(df, source, job, mode, as_of)

    def start_of_mode(df: DataFrame) -> tuple[str, Column] | None:
        return first_value(df, source, job, mode, as_of)

    return jdbc.read_jdbc(spark, source, job, rows_of_mode, start_of_mode)


def select_rows(
    df: DataFrame, source: Endpoint, job: TableJob, mode: str, as_of: date | str | None = None
) -> DataFrame:
    """The rows that the mode asks for; all of them unless incremental or daily."""
    if mode not in (INCREMENTALLY, DAILY):
        return df
    zone = source_zone(df.sparkSession, source)
    check = job.require("checkColumn").strip()
    if mode == INCREMENTALLY:
        last, inclusive = job.require("lastValue"), job.flag("inclusive", True)
        return incremental_filter(df, check, last, inclusive, zone)
    return daily_filter(df, check, previous_day(as_of), job.flag("wholeDay"), zone)


def first_value(
    df: DataFrame, source: Endpoint, job: TableJob, mode: str, as_of: date | str | None = None
) -> tuple[str, Column] | None:
    """The check column and the value at which the rows of the mode start."""
    if mode not in (INCREMENTALLY, DAILY):
        return None
    spark = df.sparkSession
    field = require_field(df, job.require("checkColumn").strip(), "check column")
    zone = source_zone(spark, source)
    if mode == INCREMENTALLY:
        return field.name, typed_literal(spark, job.require("lastValue"), field.dataType, zone)
    return field.name, day_literal(previous_day(as_of), field.dataType, zone)


def highest_value(
    spark: SparkSession, source: Endpoint, job: TableJob, mode: str, rows: DataFrame
) -> str | None:
    """The highest check value among ``rows``, those of an incremental run of a database, found by
    the database without reading them. None if there are no rows, or only NaN."""
    check = require_field(rows, job.require("checkColumn").strip(), "check column")
    found = jdbc.read_highest(spark, source, job, check.name)
    if isinstance(check.dataType, (DoubleType, FloatType)):
        top = found.first()[0]
        if top is not None and math.isnan(top):  # some have NaN above all numbers
            return highest_mark(rows, check.name)
    return highest_mark(select_rows(found, source, job, mode), check.name)


def read_table(
    spark: SparkSession, source: Endpoint, job: TableJob, mode: str, as_of: date | str | None = None
) -> DataFrame:
    """The rows to ingest."""
    df = read_source(spark, source, job, mode, as_of)
    return select_rows(df, source, job, mode, as_of)
