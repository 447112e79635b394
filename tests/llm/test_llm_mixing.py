from __future__ import annotations

import re
from collections import Counter, defaultdict

import pytest

from sluice.llm import mixing


def brute_targets(sizes, weights=(3, 1, 2)):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = 1.5 * sum(sizes.values()), set()
    while True:
        left = total - sum(2 * sizes[s] for s in stopped)
        level = left / max(sum(weight[s] for s in sizes if s not in stopped), 1e-9)
        over = {s for s in sizes if s not in stopped and weight[s] * level > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in stopped else weight[s] * level for s in sizes}
        stopped |= over


def test_targets_and_taken_words(edge):
    rows = [(r.doc_id, r.source, len(re.findall(mixing.WORD, r.text or ""))) for r in edge.collect()]
    sizes = defaultdict(int)
    for _, source, n in rows:
        sizes[source] += n
    found = mixing.mix_sizes(edge).collect()
    goals = brute_targets(sizes)
    assert Counter((r.doc_id, r["size"], r.source_size) for r in found) == Counter((i, n, sizes[s]) for i, s, n in rows)
    assert {round(r.target, 6) for r in found} == {round(goals[s], 6) for s in sizes}
    assert all(0 <= r.taken <= 2 * r["size"] for r in found)
    assert Counter(map(tuple, mixing.mix_sizes(edge.repartition(5)).collect())) == Counter(map(tuple, found))


@pytest.mark.parametrize("copies", [1, 40])
def test_sources_come_near_their_targets(tables, copies):
    docs = tables("documents", "sf0.01")
    if copies > 1:  # a hot size in a hot source
        from pyspark.sql import functions as F

        docs = docs.where("doc_id = 5").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("n").unionAll(docs)
    rows = mixing.mix_sizes(docs).groupBy("source_size", "target").agg({"taken": "sum", "size": "max"}).collect()
    for r in rows:
        assert abs(r["sum(taken)"] - r.target) <= 1.5 * r["max(size)"]


def test_the_mix_takes_whole_documents(tables, spark):
    docs = tables("documents")
    wanted = Counter()
    for r in mixing.mix_sizes(docs).collect():
        wanted[r.doc_id] += r.taken
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    got = Counter()
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    for r in mixed.collect():
        assert (r.doc_id, r.text) in texts
        got[r.doc_id] += len(re.findall(mixing.WORD, r.text or ""))
    assert +got == +wanted


def test_empty_tables_sources_and_clashing_columns(spark, nothing, clashing):
    assert mixing.mix_sizes(nothing).collect() == [] and mixing.mix(nothing).collect() == []
    blank = spark.createDataFrame([(1, " ", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert sorted(map(tuple, mixing.mix_sizes(blank).collect())) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]
    docs = clashing("row_number", "copies", "times", "each", "size", "key", "target")
    assert mixing.mix(docs).columns == docs.columns and mixing.mix(docs).count() > 0


def test_one_source_stops_at_twice_its_size(spark):
    docs = spark.createDataFrame([(i, "a b", "x") for i in range(10)] + [(99, "c " * 100, "y")], "doc_id long, text string, source string")
    found = {r.source_size: r.target for r in mixing.mix_sizes(docs).collect()}
    assert found == {20: 40.0, 100: 140.0}


def test_ranks(spark):
    from pyspark.sql import functions as F

    from sluice.llm.common import ranked

    rows = spark.createDataFrame([(f"s{i * 37 % 101}",) for i in range(101)] + [(None,)], "source string").repartition(7)
    found = ranked(rows, [F.col("source").asc_nulls_last()], "place").collect()
    order = sorted((r.source for r in found if r.source), key=str.encode)
    assert {r.source: r.place for r in found} == {s: i for i, s in enumerate([*order, None])}
