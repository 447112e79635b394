from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import search


def brute(rows, is_query, k, scale=64):
    """All products of usable vectors, with Python's whole numbers."""
    usable = [
        (i, [math.floor(scale * float(x)) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in usable:
        if is_query(q):
            found = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in usable if i != q]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def run(spark, rows, query, k=3, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return sorted(map(tuple, search.top_k(df, query, k, **more).collect()))


def test_random_vectors_with_ties_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(search, "BITS", 3)  # several passes
    monkeypatch.setattr(search, "ROWS", 16)  # several blocks
    monkeypatch.setattr(search, "QUERIES", 4)
    chance = np.random.default_rng(5)
    rows = [(i, chance.integers(-2, 3, 4).astype(float).tolist()) for i in range(150)]
    rows += [(200 + i, [1.0, 1.0, 0.0, 0.0]) for i in range(60)]  # one very common vector
    rows += rows[:20]
    wanted = brute(rows, lambda i: i % 10 == 0, 7, 2)
    assert run(spark, rows, F.col("vec_id") % 10 == 0, 7, scale=2) == wanted


def test_unusable_and_uneven_vectors(spark):
    rows = [
        (0, [1.0, 2.0]),
        (1, None),
        (2, [1.0, None]),
        (3, [float("nan"), 1.0]),
        (4, [float("inf"), 1.0]),
        (None, [1.0, 1.0]),
        (5, []),
        (6, [0.5]),
        (7, [-3.0, 0.25, 9.0]),
    ]
    assert run(spark, rows, F.lit(True), 20) == brute(rows, lambda i: True, 20)


@pytest.mark.parametrize("size", [1e5, 1e6, 1e7])
def test_large_components(spark, size):
    rows = [(i, [size * (i + 1), 1.0 * i]) for i in range(4)]
    assert run(spark, rows, F.col("vec_id") == 0, 9) == brute(rows, lambda i: i == 0, 9)


@pytest.mark.parametrize("size", [1e9, 1e25, 1e307])
def test_scores_that_are_no_longs_are_refused(spark, size):
    rows = [(i, [size * (i + 1), 1.0]) for i in range(2)]
    with pytest.raises(Exception, match="scale the vectors down|too large to be scaled"):
        run(spark, rows, F.col("vec_id") == 0, 9)


def test_scores_next_to_the_limit_are_exact(spark):
    top = 1 << 30
    rows = [(0, [float(top), 0.0]), (1, [float(top * 3), 1.0]), (2, [float(top * 3 + 1), 0.0]), (3, [-float(top * 3), 0.0])]
    found = run(spark, rows, F.col("vec_id") == 0, 9, scale=1)
    assert found == brute(rows, lambda i: i == 0, 9, 1) and found[0][3] > 1 << 61


def test_no_rows_and_no_queries(spark):
    assert run(spark, [], F.lit(True)) == []
    assert run(spark, [(1, [1.0])], F.lit(False)) == []
    assert run(spark, [(1, [1.0])], F.lit(None).cast("boolean")) == []
    assert run(spark, [(1, [1.0])], F.lit(True)) == []


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, [1.0], 5, 6), (2, [1.0], 5, 6)], "vec_id long, embedding array<float>, block int, score int")
    found = search.top_k(rows, F.col("score") == 6).collect()
    assert sorted(map(tuple, found)) == [(1, 1, 2, 4096), (2, 1, 1, 4096)]
