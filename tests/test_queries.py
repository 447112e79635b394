"""Every registered query against DuckDB over the same Parquet files."""

from __future__ import annotations

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from sluice_checks.registry import ORACLE, QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def test_each_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()
    assert QUERIES.keys() <= driver.queries().keys() and ORACLE.keys() <= driver.oracle_sql().keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, sf_dir, duck, name):
    result = driver.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    relation = duck.sql(driver.oracle_sql()[name])
    assert sorted(relation.columns) == columns
    wanted = duck.sql(f"SELECT {', '.join(columns)} FROM ({driver.oracle_sql()[name]}) AS t")
    assert Counter(map(tuple, result.select(columns).collect())) == Counter(wanted.fetchall())


def test_entry(spark):
    result = driver.entry(spark)
    assert result.count() == 750
    assert result.columns[0] == "o_orderkey"


@pytest.mark.parametrize("missing", ["xxhash", "sluice.llm", "corpus_pipeline"])
def test_the_entry_does_without_the_other_queries(missing):
    """In a process of its own in which a module cannot be imported."""
    lines = [
        "import sys, warnings",
        f"sys.modules[{missing!r}] = None",
        "warnings.simplefilter('ignore')",
        "import __spark_entry__ as driver",
        "from sluice_checks.registry import ORACLE, QUERIES",
        "assert driver.queries() == QUERIES and driver.oracle_sql() == ORACLE",
    ]
    folder = Path(driver.__file__).resolve().parent
    subprocess.run([sys.executable, "-c", "\n".join(lines)], cwd=folder, check=True)
