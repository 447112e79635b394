"""Copy database tables into Parquet, ORC or Avro datasets with Spark."""

from sluice.functions.days import previous_day
from sluice.operators.conform import avro_to_struct, conform, conform_apart, load_avro_schema
from sluice.operators.filters import daily_filter, incremental_filter
from sluice.operators.progress import observe_progress, read_progress
from sluice.operators.reconcile import Mismatch
from sluice.plans.job import RunError, ingest_table, run, run_from_files
from sluice.plans.journal import TableResult
from sluice.plans.specs import Endpoint, TableJob, load_endpoints, load_tables
from sluice.plans.validation import validate
from sluice.sinks.commits import CommitConflict
from sluice.sinks.files import read_target, resolve_format, target_path, write_table
from sluice.sources import read_source, read_table

__all__ = [
    "CommitConflict",
    "Endpoint",
    "Mismatch",
    "RunError",
    "TableJob",
    "TableResult",
    "avro_to_struct",
    "conform",
    "conform_apart",
    "daily_filter",
    "incremental_filter",
    "ingest_table",
    "load_avro_schema",
    "load_endpoints",
    "load_tables",
    "observe_progress",
    "previous_day",
    "read_progress",
    "read_source",
    "read_table",
    "read_target",
    "resolve_format",
    "run",
    "run_from_files",
    "target_path",
    "validate",
    "write_table",
]
