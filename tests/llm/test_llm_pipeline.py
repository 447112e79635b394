"""The registered queries against SQL, and the pipeline against its stages' promises."""

from __future__ import annotations

import itertools
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
import corpus_pipeline
from sluice.llm.queries import ORACLE, QUERIES


def test_all_operators_and_the_pipeline_are_registered():
    names = driver.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(ORACLE) <= set(QUERIES)


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, sf_dir, duck, name):
    result = driver.queries()[name](spark, sf_dir)
    columns = sorted(result.columns)
    wanted = duck.sql(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]}) AS t")
    assert sorted(duck.sql(ORACLE[name]).columns) == columns
    assert Counter(map(tuple, result.select(columns).collect())) == Counter(wanted.fetchall())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, sf_dir))
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    assert list(seen) == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]

    toxic = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic = 0").collect()}
    before, after = ({r.doc_id for r in x.select("doc_id").collect()} for x in seen["toxicity"])
    assert after < before and len((before - after) & toxic) <= 0.02 * len(toxic)  # clean ones stay

    from sluice.llm import simhash

    before, after = seen["near_duplicates"]
    kept = {r.doc_id for r in after.select("doc_id").collect()}
    assert kept == {r.component_id for r in simhash.near_duplicates(before).collect()}
    assert after.count() == len(kept)

    before, after = ({r.doc_id: r.text for r in x.collect()} for x in seen["secrets"])
    changed = {i for i in before if before[i] != after[i]}
    assert before.keys() == after.keys() and changed
    assert all("[SECRET]" in after[i] for i in changed) and not any("AKIA" in t for t in after.values())

    import re

    before, after = ([(r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))) for r in x.collect()] for x in seen["mixing"])
    assert sum(n for _, n in after) == pytest.approx(1.5 * sum(n for _, n in before), rel=0.05)

    before, after = seen["packing"]
    pieces = after.groupBy("doc_id").agg({"length": "sum"}).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in before.select("doc_id").collect()}


def test_empty_and_odd_documents(spark, edge, nothing, sf_dir):
    for docs in (edge, nothing):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        assert "sequence_id" in docs.columns


def test_nothing_but_the_result_is_left(spark, tmp_path, monkeypatch):
    numbers = itertools.count()
    for module in ("sluice.llm.common", "corpus_pipeline"):
        monkeypatch.setattr(f"{module}.fresh_folder", lambda _: f"{tmp_path}/{next(numbers)}")
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert rows.count() > 0 and next(numbers) > 10
    assert len([p for p in tmp_path.iterdir() if not p.name.startswith(".")]) == 1
