"""Runs: one table, or all table jobs of a mode."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor, as_completed
from contextlib import ExitStack
from datetime import date
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluice.functions.chars import with_settings
from sluice.functions.columns import column, find_field
from sluice.functions.days import previous_day, run_day
from sluice.functions.literals import unquote
from sluice.functions.shared import landed
from sluice.operators.conform import REJECTED, conform, conform_apart, load_avro_schema
from sluice.operators.filters import limit_filter
from sluice.operators.progress import observe_progress, read_progress
from sluice.operators.reconcile import checksum, compare
from sluice.plans.journal import Journal, TableResult
from sluice.plans.specs import (
    DAILY,
    INCREMENTALLY,
    Endpoint,
    TableJob,
    load_endpoints,
    load_tables,
    pick_endpoint,
)
from sluice.plans.validation import check_partition_keys, validate
from sluice.sinks.commits import Batch, Marks, tidy
from sluice.sinks.files import SPREADING, read_target, spread_rows, stages_rows, write_table
from sluice.sources import highest_value, read_table, source_zone
from sluice.sources.files import is_files

log = logging.getLogger(__name__)

# Carries the check column to the write where the schema does not keep it.
_CHECK = "__check_value"

# Rows that do not fit their schema go to a target of the table's name with this behind it.
REJECTED_TABLE = "__rejected"


class RunError(RuntimeError):
    """A run that a table ended; ``results`` are those of the tables that were finished."""

    def __init__(self, results: list[TableResult], cause: Exception):
        self.results = results
        done = "; ".join(f"{r.table_name}: {r.rows} rows, lastValue {r.last_value}" for r in results)
        super().__init__(f"{cause}\nFinished until then: {done or 'none'}")


def run(
    spark: SparkSession,
    endpoints: dict[str, Endpoint],
    tables: Iterable[TableJob],
    source_name: str,
    sink_name: str,
    mode: str,
    schemas_path: str | None = None,
    as_of: date | str | None = None,
    custom_modes: bool = False,
    tables_at_once: int = 1,
    resume: str | None = None,
) -> DataFrame:
    """Ingest the table jobs of this mode, one after another in their order.

    Everything is checked before the first table is touched. The first table that fails ends
    the run by a ``RunError``; targets written until then stay, and the error has their
    results, with the marks to continue from. Returns one row per table: ``table_name``,
    ``rows``, ``last_value``.

    Tables read by few tasks leave a large cluster idle; with ``tables_at_once`` several are
    in work at a time, but never two with the same target.

    ``resume`` names the run. What it has finished is noted at the sink, and a run of the same name, with
    the same jobs and settings, goes on behind that, for the same day.
    """
    source, sink = pick_endpoint(endpoints, source_name), pick_endpoint(endpoints, sink_name)
    jobs = validate(list(tables), source, sink, mode, custom_modes)
    schemas = [job_schema(spark, job, schemas_path) for job in jobs]
    finished: dict[int, TableResult] = {}
    journal = Journal(spark, sink, resume) if resume is not None else None
    if journal is not None:
        given = run_day(as_of).isoformat() if as_of is not None else None
        settings = {"mode": mode, "source": source_name, "as_of": given, "jobs": [[j.name, j.options] for j in jobs]}
        if given is None and not journal.begun:
            settings["as_of"] = run_day().isoformat()
        as_of = journal.begin(settings)["as_of"]
        finished = journal.finished()
    as_of = run_day(as_of)  # the same for all tables, also if midnight passes meanwhile

    def ingest(numbers: list[int]) -> None:
        for i in numbers:
            if i in finished:
                log.info("finished before: %s", finished[i])
                continue
            result = ingest_table(spark, jobs[i], source, sink, mode, schemas[i], as_of)
            if journal is not None:
                journal.add(i, result)
            finished[i] = result
            log.info("%s", result)

    try:
        _in_turns(spark, ingest, jobs, tables_at_once)
    except Exception as error:
        raise RunError([finished[i] for i in sorted(finished)], error) from error
    finally:
        tidy(spark, sink)
    results = [finished[i] for i in sorted(finished)]
    return spark.createDataFrame(
        [(r.table_name, r.rows, r.last_value) for r in results],
        "table_name string, rows bigint, last_value string",
    )


def _in_turns(spark: SparkSession, ingest: Callable, jobs: list[TableJob], at_once: int) -> None:
    """Runs ``ingest`` for all jobs by number, where jobs of one target stay in order."""
    if at_once <= 1 or len(jobs) <= 1:
        return ingest(list(range(len(jobs))))
    chains: dict[str, list[int]] = {}
    for i, job in enumerate(jobs):
        chains.setdefault(job.table_name, []).append(i)
    with ThreadPoolExecutor(at_once) as pool:
        work = inheritable_thread_target(spark)(ingest)
        waiting = [pool.submit(work, chain) for chain in chains.values()]
        try:
            for one in as_completed(waiting):
                one.result()
        except BaseException:
            pool.shutdown(cancel_futures=True)  # those in work come to their end
            raise


def run_from_files(
    spark: SparkSession,
    endpointsConfigPath: str,
    tablesConfigPath: str,
    sourceName: str,
    sinkName: str,
    mode: str,
    schemasPath: str | None = None,
    as_of: date | str | None = None,
    **more: Any,
) -> DataFrame:
    """``run`` with the endpoints and table jobs of two JSON files."""
    endpoints = load_endpoints(spark, endpointsConfigPath)
    tables = load_tables(spark, tablesConfigPath)
    return run(spark, endpoints, tables, sourceName, sinkName, mode, schemasPath, as_of, **more)


def job_schema(
    spark: SparkSession, job: TableJob, schemas_path: str | None
) -> StructType | None:
    """The table job's Avro schema as columns, if it has one."""
    name = job.get("schema")
    if name is None:
        return None
    if not schemas_path:
        raise ValueError(f"table job '{job.name}' has a schema, but the run has no schemas path")
    schema = load_avro_schema(spark, f"{schemas_path}/{name}")
    check_partition_keys(job, schema)
    return schema


def ingest_table(
    spark: SparkSession,
    job: TableJob,
    source: Endpoint,
    sink: Endpoint,
    mode: str,
    schema: StructType | None = None,
    as_of: date | str | None = None,
) -> TableResult:
    """Read, filter, conform and write one table.

    This is a single stage without a shuffle, unless the rows are spread by their partition
    keys before they are written. An incremental run of a database first asks it for the highest
    check value, and copies nothing behind that.
    """
    if spreads_rows(job, source):
        spark = with_settings(spark, SPREADING)
    marks, number = None, 0
    if job.flag("keepMarks"):
        marks = Marks(spark, sink, job)
        number, mark = marks.last()
        job = continued(job, mark)
    rows = read_table(spark, source, job, mode, as_of)
    check = find_field(rows.schema, job.get("checkColumn", "").strip())
    observed = check.name if check else None
    limited = mode == INCREMENTALLY and not is_files(source)
    if limited:
        # Ranges are read at different moments. Rows that come meanwhile are left to the next run,
        # also where one range would still see those above others that no range did.
        limit = highest_value(spark, source, job, mode, rows)
        rows = limit_filter(rows, check.name, limit, source_zone(spark, source))
    day = previous_day(as_of) if mode == DAILY else None
    rejected, seen = 0, None
    with ExitStack() as until_written:
        if schema is not None:
            if check:
                rows = rows.withColumn(_CHECK, column(check.name))
                schema = StructType([*schema.fields, rows.schema[_CHECK]])
                observed = _CHECK
            if job.flag("quarantine"):
                rows, rejected, seen = _without_rejected(rows, schema, sink, job, source, mode, day, until_written)
            else:
                rows = conform(rows, schema, "null" if job.flag("lenientCasts") else "fail")
        if spreads_rows(job, source):
            if not is_files(source) and seen is None:
                rows = until_written.enter_context(landed(rows))
            rows = spread_rows(rows, job.partition_keys)
        sent = rows.drop(_CHECK)
        sums = [checksum(sent, job.partition_keys).alias("total")] if job.flag("reconcile") else []
        rows, observation = observe_progress(rows, observed, *sums)

        def arrived(folder: str) -> None:
            if job.flag("reconcile"):
                there = read_target(spark, folder, sink.require("format"), sent.schema, job.partition_keys)
                count, total = observation.get["rows"], observation.get["total"]
                compare(there, job.partition_keys, count, total, job.table_name)

        def kept() -> dict:
            count, last_value = read_progress(observation)
            return {"rows": count, "to": limit if limited else last_value}

        batch = Batch(_identity(job, source, mode, day), kept) if _repeats_safely(job) else None
        path = write_table(rows.drop(_CHECK), sink, job, mode, day, batch, arrived)
    count, last_value = read_progress(observation)
    if seen is not None:  # rejected rows count for the mark: they are dealt with, too
        last_value = read_progress(seen)[1]
    last_value = limit if limited else last_value
    if last_value is None:
        last_value = job.get("lastValue")
    if marks is not None and last_value != job.get("lastValue"):
        marks.set(number, last_value, check.name)
    return TableResult(job.table_name, count, last_value, path, rejected)


def continued(job: TableJob, mark: str | None) -> TableJob:
    """The job from a mark on that was kept; the rows at the mark are there already."""
    if mark is None:
        return job
    return TableJob(job.name, job.options | {"lastValue": mark, "inclusive": job.get("inclusive", "false")})


def _repeats_safely(job: TableJob) -> bool:
    return job.flag("repeatSafe") or job.flag("keepMarks")


def _identity(job: TableJob, source: Endpoint, mode: str, day: date | None) -> dict:
    """What two runs must share for one to be a repetition of the other."""
    shared = {"job": job.name, "source": source.name, "mode": mode, "check": job.get("checkColumn", "").strip()}
    if mode == INCREMENTALLY:
        return shared | {"from": unquote(job.require("lastValue"))}
    return shared | {"day": day.isoformat() if day else None}


def _without_rejected(
    rows: DataFrame,
    schema: StructType,
    sink: Endpoint,
    job: TableJob,
    source: Endpoint,
    mode: str,
    day: date | None,
    until_written: ExitStack,
) -> tuple[DataFrame, int, Observation]:
    """The rows that fit the schema; those that do not are written to a target of their own, as they
    were, with what did not fit. The source is read once: rows are landed in between.

    Also how many do not fit, and the progress of all.
    """
    name = REJECTED
    while find_field(rows.schema, name) is not None:
        name += "_"
    apart = conform_apart(rows, schema, name)
    bad = F.size(column(name)) > 0
    observed = None
    if find_field(rows.schema, _CHECK) is not None:
        apart, observed = apart.withColumn(_CHECK, F.col("source").getField(_CHECK)), _CHECK
    count = F.coalesce(F.sum(F.when(bad, 1).otherwise(0)), F.lit(0)).alias("rejected")
    apart, seen = observe_progress(apart, observed, count)
    apart = until_written.enter_context(landed(apart))
    rejected = int(seen.get["rejected"])
    options = {k: v for k, v in job.options.items() if k not in ("partitionKeys", "replacePartitions", "keepMarks", "reconcile")}
    if job.flag("replacePartitions") or job.flag("keepMarks"):
        options["repeatSafe"] = "true"
    side = TableJob(job.name, options | {"tableName": job.table_name + REJECTED_TABLE})
    if rejected or stages_rows(sink, side, mode):
        batch = Batch(_identity(job, source, mode, day)) if _repeats_safely(side) else None
        write_table(apart.where(bad).select("source.*", column(name)).drop(_CHECK), sink, side, mode, day, batch)
    return apart.where(~bad).select("conformed.*"), rejected, seen


def spreads_rows(job: TableJob, source: Endpoint) -> bool:
    """Whether rows are shuffled by their partition keys: as ``rebalance`` says.

    If it says nothing, rows of a database are not: its few read tasks write few files. File
    datasets are read by many tasks, each of which would write a file per key it meets, so
    theirs are.
    """
    if job.get("rebalance") is not None:
        return job.flag("rebalance")
    return is_files(source) and bool(job.partition_keys)
