"""Folders that all executors reach."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


@cache
def _own_folder() -> tempfile.TemporaryDirectory:
    """For local mode, where driver and tasks are one process; gone when that ends."""
    return tempfile.TemporaryDirectory(prefix="sluice-")


def fresh_folder(spark: SparkSession) -> str:
    """An unused path in the shared folder of the cluster; in local mode it may be any folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = _own_folder().name
    return f"{shared.rstrip('/')}/sluice-{uuid.uuid4().hex}"


@contextmanager
def landed(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written to the shared folder and read from there, until the block ends.

    Whatever is repeated behind it, after the loss of an executor say, reads the same rows
    again, which a database that is being changed does not promise.
    """
    spark = df.sparkSession
    folder = fresh_folder(spark)
    try:
        df.write.parquet(folder)
        yield spark.read.schema(df.schema).parquet(folder)
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
