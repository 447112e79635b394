"""Database tables through Spark's JDBC reader.

A table is always named as a table, never as a query text: filters and projections come
from Catalyst, which renders them for the database at hand.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from sluice.functions.chars import read_as_text
from sluice.functions.columns import column, require_field
from sluice.functions.literals import unquote
from sluice.plans.specs import SPLIT_OPTIONS, Endpoint, TableJob
from sluice.sources.credentials import check_credentials, connection_properties
from sluice.sources.splits import (
    AT_ONCE,
    SplitColumn,
    balanced_ranges,
    clock_zone,
    quoted_name,
    time_cuts,
)

# Fixed values of Oracle connections: the URL form, the formats in which the session reads
# dates and timestamps given as text (Spark gives partition bounds so), and the driver
# setting by which DATE columns arrive as dates.
ORACLE = "oracle"
ORACLE_URL = "jdbc:oracle:thin:/@{host}:{port}/{dbName}"
ORACLE_SESSION = (
    "ALTER SESSION SET NLS_DATE_FORMAT = 'YYYY-MM-DD'",
    "ALTER SESSION SET NLS_TIMESTAMP_FORMAT = 'YYYY-MM-DD HH24:MI:SS.FF6'",
)
ORACLE_DATES = ("oracle.jdbc.mapDateToTimestamp", "false")

# Rows per round trip where no batchSize says otherwise. Drivers' own defaults are ten rows, or
# all of a partition at once.
ROWS_PER_TRIP = 1000


def is_oracle(source: Endpoint) -> bool:
    kind = source.get("dbType")
    if kind is None:
        return (source.get("url") or "").startswith("jdbc:oracle:")
    return kind.strip().lower() == ORACLE


def jdbc_url(source: Endpoint) -> str:
    """The option ``url``, else one made from host, port and database name."""
    url = source.get("url")
    if url:
        return url
    kind = source.require("dbType")
    if not is_oracle(source):
        raise ValueError(
            f"endpoint '{source.name}': no connection URL is known for dbType '{kind}';"
            " give the option 'url'"
        )
    return ORACLE_URL.format(**{o: source.require(o) for o in ("host", "port", "dbName")})


def check_endpoint(source: Endpoint) -> None:
    jdbc_url(source)
    source.require("driver")
    check_credentials(source)
    source.positive("batchSize")
    source.flag("preferTimestampNTZ")


def keeps_clock(spark: SparkSession, url: str) -> bool:
    """Whether timestamps without a zone can be read as such from this database.

    Not every dialect in Spark can write literals of that type, and most keep the clock time
    only where the JVM's zone is UTC. Asked here is the dialect itself.
    """
    moment = "2001-02-03 04:05:06"
    dialect = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(url)
    clock = spark._jvm.java.time.LocalDateTime.parse(moment.replace(" ", "T"))
    arrived = spark._jvm.java.sql.Timestamp.valueOf(moment)
    literal = str(dialect.compileValue(clock))
    return moment in literal and dialect.convertJavaTimestampToTimestampNTZ(arrived).equals(clock)


def jdbc_options(spark: SparkSession, source: Endpoint, job: TableJob) -> dict[str, str]:
    """Reader options except for the credentials and the split into partitions."""
    options = {"driver": source.require("driver")}
    if is_oracle(source):
        # Only one statement is possible, so both settings go into one block.
        steps = " ".join(_execute(statement) for statement in ORACLE_SESSION)
        options["sessionInitStatement"] = f"BEGIN {steps} END;"
        options[ORACLE_DATES[0]] = ORACLE_DATES[1]
    # So read, they do not depend on the session's zone; else they are instants of the JVM's.
    possible = keeps_clock(spark, jdbc_url(source))
    wanted = source.flag("preferTimestampNTZ", possible)
    if wanted and not possible:
        raise ValueError(
            f"endpoint '{source.name}': preferTimestampNTZ must be false, as Spark would shift"
            f" the times of this database, or could not compare them, in zone {clock_zone(spark)}"
        )
    options["preferTimestampNTZ"] = str(wanted).lower()
    rows_per_trip = job.positive("batchSize") or source.positive("batchSize") or ROWS_PER_TRIP
    options["fetchsize"] = str(rows_per_trip)
    return options


def _execute(statement: str) -> str:
    return "EXECUTE IMMEDIATE '" + statement.replace("'", "''") + "';"


def loader(spark: SparkSession, source: Endpoint, job: TableJob) -> Callable[..., DataFrame]:
    """Reads the job's table, or a query in its place, with all options but for the split."""
    options = jdbc_options(spark, source, job)
    url, properties = jdbc_url(source), connection_properties(spark, source)

    def load(
        predicates: list[str] | None = None,
        split: dict[str, str] | None = None,
        table: str = job.table_name,
    ) -> DataFrame:
        def read(session: SparkSession) -> DataFrame:
            reader = session.read.options(**options, **(split or {}))
            return reader.jdbc(url, table, predicates=predicates, properties=properties)

        return read_as_text(spark, read)

    return load


def read_highest(spark: SparkSession, source: Endpoint, job: TableJob, name: str) -> DataFrame:
    """The highest value of a column, found by the database: one row, in a column of the same name."""
    quoted = quoted_name(spark, jdbc_url(source), name)
    query = f"(SELECT MAX({quoted}) AS {quoted} FROM {job.table_name}) highest"
    return loader(spark, source, job)(table=query)


def check_order(text: SplitColumn, table: str, load: Callable[..., DataFrame]) -> None:
    """Refuses a text column that the database sorts otherwise than Spark does: a row could then be
    in two of its ranges, or in none. The database says so itself, for the cuts that were made."""
    cuts = sorted(text.used)
    for first in range(0, len(cuts) - 1, AT_ONCE):
        found = load(table=text.disorder_of(table, cuts[first : first + AT_ONCE + 1])).first()
        if found[0]:
            raise ValueError(
                f"the database does not sort the partitionColumn {text.name} as Spark does, by code"
                " points; split by a number, date or timestamp instead"
            )


def read_jdbc(
    spark: SparkSession,
    source: Endpoint,
    job: TableJob,
    rows_of_mode: Callable[[DataFrame], DataFrame] = lambda df: df,
    start_of_mode: Callable[[DataFrame], tuple[str, Column] | None] = lambda df: None,
) -> DataFrame:
    """The table, read in parallel ranges of one column where the job asks for it.

    The bounds only set how wide the ranges are: the first and the last one are open, so all
    rows are read. Without bounds the database is asked for the lowest and highest value. Every
    range is one task with one connection, and a range with many rows is one long task. ``balanceReads`` needs no bounds and makes ranges of about as many rows
    each, counting only the rows of the mode; it splits by text, too, if the database sorts that as Spark does.
    """
    url, load = jdbc_url(source), loader(spark, source, job)
    rows = load()
    balanced = job.flag("balanceReads")
    if not (job.splits_read or balanced):
        return rows

    parts = job.positive("numPartitions")
    # A balanced read may name a second column, to split single values with many rows.
    names = job.require("partitionColumn").split(",", maxsplit=1 if balanced else 0)
    fields = [require_field(rows, name.strip(), "partitionColumn") for name in names]
    columns = [SplitColumn(spark, url, field, text=balanced) for field in fields]
    name, start = start_of_mode(rows) or (None, None)
    if balanced:
        last = columns[-1]
        found = load(table=last.bounds_of(job.table_name))
        low, high = (column(limit) for limit in found.columns)
        if name == fields[-1].name:
            low = F.greatest(low, start)
        bounds = found.select(last.on_clock(low), last.on_clock(high)).first()
        for one in columns:
            if one.is_text:
                one.between(*(bounds if one is last else load(table=one.bounds_of(job.table_name)).first()))

        def count(strides: list[tuple]) -> list[int]:
            """Rows of the table in each stride, counted by the database."""
            found = [0] * len(strides)
            for first in range(0, len(strides), AT_ONCE):
                query = last.histogram_of(job.table_name, strides[first : first + AT_ONCE])
                for part, n in load(table=query).collect():  # a row for each stride at most
                    found[first + int(part)] = int(n)
            return found

        ranges = balanced_ranges(columns, parts, lambda some: rows_of_mode(load(some)), bounds, count)
        for one in columns:
            if one.is_text:
                check_order(one, job.table_name, load)
        return load(ranges)

    if job.get("lowerBound") is None:
        found = load(table=columns[0].bounds_of(job.table_name))
        lower, upper = found.select(*columns[0].as_bounds(*map(column, found.columns))).first()
        if lower is None or upper is None:
            return rows
    else:
        lower, upper = (unquote(job.require(option)) for option in SPLIT_OPTIONS[1:3])
    if name == fields[0].name:
        lower = columns[0].raised(lower, upper, start)
    if isinstance(fields[0].dataType, TimestampNTZType):
        # Spark's own split refuses this type.
        return load(columns[0].ranges(time_cuts(lower, upper, parts)))
    bounds = {"lowerBound": lower, "upperBound": upper}
    return load(split={"partitionColumn": fields[0].name, "numPartitions": str(parts)} | bounds)
