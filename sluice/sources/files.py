"""File datasets as a source: the same jobs over files that were exported earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.functions.chars import read_as_text, with_settings
from sluice.plans.specs import Endpoint, TableJob
from sluice.sinks.files import resolve_format

# Formats that are read a second time, and whole, just to guess their types.
UNTYPED = ("csv", "json", "text", "xml")

# Formats that can be asked for the columns of all files, not just of one of them.
MERGING = ("parquet", "orc")


def is_files(source: Endpoint) -> bool:
    database = any(source.get(option) for option in ("url", "dbType", "driver", "host"))
    return bool(source.get("format") and source.get("location")) and not database


def check_endpoint(source: Endpoint) -> None:
    name = source.require("format").strip().lower()
    if name in UNTYPED:
        raise ValueError(
            f"endpoint '{source.name}': files of format '{name}' do not say their types;"
            " a source needs a format that does, such as parquet, orc or avro"
        )
    source.flag("mergeSchema")


def read_files(spark: SparkSession, source: Endpoint, job: TableJob) -> DataFrame:
    """``location/tableName``, or ``location`` itself with ``{table}`` filled in.

    The columns are those of all files together, NULL where a file lacks one; finding them
    reads every footer, which ``mergeSchema=false`` saves. The values of partition folders
    are text, as they are written: as numbers ``007`` and ``7`` would become one.
    """
    location, table = source.require("location"), job.table_name
    path = location.replace("{table}", table) if "{table}" in location else f"{location}/{table}"
    name = source.require("format").strip().lower()
    merge = name in MERGING and source.flag("mergeSchema", True)

    def read(session: SparkSession) -> DataFrame:
        own = with_settings(session, {"spark.sql.sources.partitionColumnTypeInference.enabled": "false"})
        reader = own.read.format(resolve_format(source.require("format")))
        return (reader.option("mergeSchema", "true") if merge else reader).load(path)

    return read_as_text(spark, read)
