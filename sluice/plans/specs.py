"""Endpoints and table jobs, and reading them from their JSON files."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# The modes and the option names of the two configuration files.
COMPLETELY = "completely"
INCREMENTALLY = "incrementally"
DAILY = "daily"
MODES = (COMPLETELY, INCREMENTALLY, DAILY)
SPLIT_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")

_ITEMS = "array<struct<name:string, options:array<struct<name:string, value:string>>>>"


@dataclass(frozen=True)
class _Spec:
    """A named set of text options."""

    name: str
    # Not shown when printed: an endpoint's options may hold a password.
    options: dict[str, str] = field(default_factory=dict, repr=False)

    kind = "item"

    def get(self, option: str, default: str | None = None) -> str | None:
        return self.options.get(option, default)

    def require(self, option: str) -> str:
        value = self.options.get(option)
        if value is None or not value.strip():
            raise ValueError(f"{self.kind} '{self.name}' needs the option '{option}'")
        return value

    def flag(self, option: str, default: bool = False) -> bool:
        value = self.options.get(option)
        if value is None:
            return default
        if value.strip().lower() not in ("true", "false"):
            raise ValueError(
                f"{self.kind} '{self.name}': option '{option}' must be true or false, not '{value}'"
            )
        return value.strip().lower() == "true"

    def positive(self, option: str) -> int | None:
        value = self.options.get(option)
        if value is None:
            return None
        if not value.strip().isdecimal() or int(value) < 1:
            raise ValueError(
                f"{self.kind} '{self.name}': option '{option}' must be a positive whole number,"
                f" not '{value}'"
            )
        return int(value)


@dataclass(frozen=True)
class Endpoint(_Spec):
    """Where a source or a sink lives."""

    kind = "endpoint"


@dataclass(frozen=True)
class TableJob(_Spec):
    """One table to copy. ``name`` is a label; the option ``tableName`` says which table."""

    kind = "table job"

    @property
    def table_name(self) -> str:
        return self.require("tableName")

    @property
    def partition_keys(self) -> list[str]:
        keys = [k.strip() for k in self.get("partitionKeys", "").split(",")]
        return [k for k in keys if k]

    @property
    def splits_read(self) -> bool:
        """Whether the options of a parallel read are there: column and number, both bounds or none."""
        column, lower, upper, number = (self.get(option) is not None for option in SPLIT_OPTIONS)
        return column and number and lower == upper


def load_endpoints(spark: SparkSession, path: str) -> dict[str, Endpoint]:
    """Endpoints by name; of two with the same name the first one counts."""
    found: dict[str, Endpoint] = {}
    for name, options in _load_items(spark, path, "endpoints"):
        found.setdefault(name, Endpoint(name, options))
    return found


def load_tables(spark: SparkSession, path: str) -> list[TableJob]:
    """Table jobs in file order."""
    return [TableJob(name, options) for name, options in _load_items(spark, path, "tables")]


def _load_items(spark: SparkSession, path: str, key: str) -> list[tuple[str, dict[str, str]]]:
    rows = (
        spark.read.schema(f"{key} {_ITEMS}")
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .json(path)
        .selectExpr(f"inline({key})")
        .collect()  # a configuration file, not table data
    )
    if not rows:
        raise ValueError(f"'{path}' holds no list named '{key}'")
    items = []
    for row in rows:
        if not row.name:
            raise ValueError(f"'{path}': an item of '{key}' has no name")
        options: dict[str, str] = {}
        for option in row.options or []:
            if option.name and option.value is not None:
                options.setdefault(option.name, option.value)
        items.append((row.name, options))
    return items


def pick_endpoint(endpoints: dict[str, Endpoint], name: str) -> Endpoint:
    if name not in endpoints:
        raise KeyError(f"no endpoint named '{name}'; there are {sorted(endpoints)}")
    return endpoints[name]


def select_jobs(tables: Iterable[TableJob], mode: str) -> list[TableJob]:
    return [job for job in tables if job.get("mode") == mode]
