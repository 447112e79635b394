"""File datasets as a sink: ``location/tableName``, written by Spark's own writers."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.chars import with_settings
from sluice.functions.columns import column, find_field
from sluice.functions.folders import Folders, escaped
from sluice.plans.specs import COMPLETELY, Endpoint, TableJob
from sluice.sinks.commits import Batch, Commits, Replacement

# Fixed value: Spark's Avro format by its class, which is there with or without the Avro module;
# the short name is known only with it.
AVRO = "org.apache.spark.sql.avro.AvroFileFormat"

# For the session of rows that are spread: what a task costs is its files, one for each key, and not their
# bytes. Otherwise less than a megabyte is one task's, however many keys it has.
SPREADING = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b"}

# For the session that opens a target with partition folders. Its folders are listed by at most so many tasks, not
# 10,000, and opening a small file counts as little as it takes, for which a task reads more of them.
LISTERS = 256
OPEN_COST = 512 * 1024

# Up to so many files Spark finds the partitions of a target by itself. Its steps are half the square of their
# number: seconds then, about a minute for 200,000.
FOUND_BY_SPARK = 20_000

# Fixed value: the folder of NULL.
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"

# Sink options handed to the writer.
WRITER_OPTIONS = ("compression", "maxRecordsPerFile")


def resolve_format(name: str) -> str:
    """The name by which Spark knows a format; only ``avro`` has another."""
    return AVRO if name.strip().lower() == "avro" else name.strip()


def target_path(sink: Endpoint, job: TableJob) -> str:
    return f"{sink.require('location')}/{job.table_name}"


def is_adaptive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.adaptive.enabled").lower() == "true"


def spread_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bring rows of the same partition keys together, to write few and even files.

    This is a shuffle. Adaptive execution splits a key with many rows over several tasks and
    puts small ones together; without it, all rows of a key would have to pass through one
    task, so that is refused. Have at least as many shuffle partitions as keys: keys that
    share one are split together. In a session with ``SPREADING`` many keys of few rows are
    written by as many tasks as there are cores.
    """
    if not is_adaptive(df.sparkSession):
        raise ValueError(
            "rows are only spread by their partition keys with spark.sql.adaptive.enabled;"
            " enable it or set rebalance=false"
        )
    return df.hint("rebalance", *[column(key) for key in keys])


def read_target(
    spark: SparkSession, path: str, format: str, schema: StructType, keys: list[str] | None = None
) -> DataFrame:
    """The rows of a target, or of rows staged for it, with the columns of ``schema``. ``keys`` are its
    partition keys.

    If it has many files, the values of the keys come from the path of each, in the tasks that read it, and not
    from a list of folders that the driver makes.
    """
    format, keys = resolve_format(format), [find_field(schema, key).name for key in keys or []]
    if not keys:
        return spark.read.format(format).schema(schema).load(path).select(*map(column, schema.names))
    session = _opening(spark)
    own = StructType([field for field in schema.fields if field.name not in keys])
    rows = session.read.format(format).schema(own).option("recursiveFileLookup", "true").load(path)
    if len(rows._jdf.inputFiles()) <= FOUND_BY_SPARK:
        return session.read.format(format).schema(schema).load(path).select(*map(column, schema.names))
    parts = F.split(rows.metadataColumn("_metadata").getField("file_path"), "/")
    values = {field.name: column(field.name) for field in own.fields}
    for i, key in enumerate(keys):
        part = F.element_at(parts, i - len(keys) - 1)  # the file's name is the last
        values[key] = _folder_value(part).cast(schema[key].dataType).alias(key)
    return rows.select(*[values[name] for name in schema.names])


def _opening(spark: SparkSession) -> SparkSession:
    listers = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    fewer = str(min(LISTERS, int(spark.conf.get(listers))))
    return with_settings(spark, {listers: fewer, "spark.sql.files.openCostInBytes": str(OPEN_COST)})


def _folder_value(part: Column) -> Column:
    """The value in ``key=value``, the name of a partition folder as the path of a file gives it: escaped as a
    folder's name, and again as a part of an address."""
    value = F.regexp_replace(_unescaped(part), "^[^=]*=", "")
    return F.when(value != NULL_FOLDER, _unescaped(value))


def _unescaped(text: Column) -> Column:
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))  # a plus would become a blank


def folders_of_day(spark: SparkSession, path: str, key: str, day: date) -> list[str]:
    """The folders of a day in a target: those of the first partition key with the day as their value,
    or any time of that day."""
    folders = Folders(spark)
    key = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(key)
    letters = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() and c.isascii() else escaped(c) for c in key)
    start = f"{letters}={day.isoformat()}"
    return folders.matching(path, start, f"{start} *", f"{start}[tT]*")


def stages_rows(sink: Endpoint, job: TableJob, mode: str) -> bool:
    """Whether rows are written beside the target first and put there when all are written: where old
    rows give way to them, or where the job has them checked or told from others."""
    if any(job.flag(option) for option in ("repeatSafe", "keepMarks", "reconcile")):
        return True
    replaces = mode == COMPLETELY or job.flag("replacePartitions")
    return replaces and sink.flag("stagedWrites", True)


def write_table(
    df: DataFrame,
    sink: Endpoint,
    job: TableJob,
    mode: str,
    day: date | None = None,
    batch: Batch | None = None,
    check: Callable[[str], None] | None = None,
) -> str:
    """Write the rows and return the target path.

    A complete copy replaces the target, anything else is added to it. With
    ``replacePartitions`` all that the target holds of ``day`` goes, so that a repeated
    daily run gives what a single one does, also where rows have moved or are gone. A ``batch``
    replaces an earlier one with the same identity. What is replaced stays until the new rows are
    complete and ``check``, given the folder that holds them, has not raised.
    """
    spark, path = df.sparkSession, target_path(sink, job)
    replaces_day = mode != COMPLETELY and job.flag("replacePartitions")
    if replaces_day and day is None:
        raise ValueError("replacePartitions needs the day whose rows are replaced")
    writer = df.write.format(resolve_format(sink.require("format")))
    for option in WRITER_OPTIONS:
        if sink.get(option):
            writer = writer.option(option, sink.get(option))
    if job.partition_keys:
        writer = writer.partitionBy(*job.partition_keys)

    if not stages_rows(sink, job, mode):
        if mode == COMPLETELY:
            # Whatever the session says: a complete copy leaves no partition of the old one.
            writer.mode("overwrite").option("partitionOverwriteMode", "static").save(path)
            return path
        if replaces_day:
            for name in folders_of_day(spark, path, job.partition_keys[0], day):
                Folders(spark).delete(f"{path}/{name}")
        writer.mode("append").save(path)
        return path

    commits = Commits(spark, sink, job)
    commits.recover()
    staged = commits.staged()
    try:
        writer.mode("errorifexists").save(staged)
        if check is not None:
            check(staged)
    except BaseException:
        commits.drop(staged)
        raise
    names = []
    if replaces_day:
        names = folders_of_day(spark, path, job.partition_keys[0], day)
    commits.commit(staged, Replacement(mode == COMPLETELY, names), batch)
    return path
