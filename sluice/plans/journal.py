"""What a run has finished, kept at the sink, for a run that goes on where another one broke off."""

from __future__ import annotations

from dataclasses import asdict, dataclass
from urllib.parse import quote

from pyspark.sql import SparkSession

from sluice.functions.folders import Folders
from sluice.plans.specs import Endpoint
from sluice.sinks.commits import STATE


@dataclass(frozen=True)
class TableResult:
    """What a table's run wrote, and the ``lastValue`` to continue from."""

    table_name: str
    rows: int
    last_value: str | None
    path: str
    rejected: int = 0


class Journal:
    """The finished tables of the run of a name, by their number in the run."""

    def __init__(self, spark: SparkSession, sink: Endpoint, name: str):
        if not name.strip():
            raise ValueError("a run to be resumed needs a name")
        self._folders, self._name = Folders(spark), name
        self._folder = f"{sink.require('location')}/{STATE}/_runs/{quote(name, safe='')}"

    @property
    def begun(self) -> bool:
        return self._folders.read(f"{self._folder}/run.json") is not None

    def begin(self, settings: dict) -> dict:
        """The settings of the run: those of its first attempt, which all others must share. What
        is None here is taken from there."""
        path = f"{self._folder}/run.json"
        known = self._folders.read(path)
        if known is None:
            self._folders.delete(path)  # should it have broken off
            self._folders.create(path, settings)
            return settings
        for key, value in settings.items():
            if value is not None and known[key] != value:
                raise ValueError(
                    f"the run '{self._name}' was begun with another {key}: {known[key]}, not {value}"
                )
        return known

    def finished(self) -> dict[int, TableResult]:
        found = {}
        for name in self._folders.names(self._folder):
            if name.endswith(".json") and name[:-5].isdecimal():
                content = self._folders.read(f"{self._folder}/{name}")
                if content is not None:
                    found[int(name[:-5])] = TableResult(**content)
        return found

    def add(self, number: int, result: TableResult) -> None:
        path = f"{self._folder}/{number:06d}.json"
        self._folders.delete(path)
        self._folders.create(path, asdict(result))
