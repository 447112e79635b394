from __future__ import annotations

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.llm import toxicity
from sluice.llm.common import held_out, labelled_sample
from sluice.llm.queries import op10_toxicity


@settings(deadline=None, max_examples=300)
@given(st.lists(st.integers(-4, 4), max_size=14))
def test_segments_are_the_maximal_ones(values):
    """Ruzzo and Tompa's recursive definition: the best segment, then what is left and right of it."""
    scores = np.array(values, float)

    def wanted(first, end):
        spans = [(scores[a:b].sum(), -(b - a), -a, a, b) for a, b in itertools.combinations(range(first, end + 1), 2)]
        best = max(spans, default=(0,))
        if best[0] <= 0:
            return []
        _, _, _, a, b = best
        return wanted(first, a) + [(best[0], a, b)] + wanted(b, end)

    # Ties between equally good segments may be cut differently; totals and the best are the same.
    found, exact = toxicity.segments(scores), wanted(0, len(scores))
    assert all(scores[a:b].sum() == s > 0 for s, a, b in found)
    assert all(x[2] <= y[1] for x, y in itertools.pairwise(found))
    assert max((s for s, _, _ in found), default=0) == max((s for s, _, _ in exact), default=0)


def test_held_out_rows(spark):
    import zlib

    rows = spark.range(50).select(F.col("id"), held_out(F.col("id")).alias("out")).collect()
    assert all(r.out == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in rows)
    assert not spark.sql("SELECT CAST(NULL AS LONG) AS id").select(held_out(F.col("id"))).first()[0]


def test_the_sample_leaves_out_what_it_must(spark, edge):
    labels = spark.createDataFrame(
        [(i, i % 2, None) for i in range(60)] + [(3, 0, 1), (4, None, 1), (None, 1, 1)], "doc_id long, toxic int, quality int"
    )
    docs = spark.createDataFrame([(i, f"{i} " * 9) for i in range(60)] + [(5, "x"), (None, "y")], "doc_id long, text string")
    import zlib

    rows = labelled_sample(docs, labels, "toxic", 10).collect()
    assert not any(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    assert sorted(r.label for r in rows) == [0] * 10 + [1] * 10 and all(r.label == r.doc_id % 2 for r in rows)
    assert 3 not in {r.doc_id for r in rows}
    assert labelled_sample(docs, labels, "quality", 10).count() <= 10


def test_copies_count_once(spark):
    docs = spark.createDataFrame([(i, "the same five words here") for i in range(90)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(90)], "doc_id long, toxic int")
    assert labelled_sample(docs, labels, "toxic", 50).count() == 1


def test_accuracy_on_held_out_rows(spark, tables):
    rows = op10_toxicity(spark, "/root/testdata/sf0.1").join(tables("labels", "sf0.1"), "doc_id").where("held_out")
    seen = {(r.toxic, r.predicted): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    right = seen.get((1, 1), 0)
    assert right / (right + seen.get((1, 0), 0)) > 0.9 and right / (right + seen.get((0, 1), 0)) > 0.95


@pytest.fixture(scope="module")
def model(tables):
    return toxicity.fit(tables("documents", "sf0.01"), tables("labels", "sf0.01"))


def test_edge_documents(edge, clashing, nothing, model):
    judged = toxicity.judge(edge, model).collect()
    assert len(judged) == edge.count() and all(0 <= r.toxicity.score < toxicity.CUT for r in judged)
    assert judged[0].toxicity.score == [r for r in judged if r.text == ""][0].toxicity.score
    docs = clashing("toxicity", "score", "evidence")
    assert toxicity.judge(docs, model).columns[-1] == "toxicity_"
    assert toxicity.without_toxic(docs, model).columns == docs.columns
    assert toxicity.without_toxic(docs, model).count() == docs.count()
    assert toxicity.judge(nothing, model).collect() == []


def test_toxic_passages_are_found(spark, model):
    plain = "the of and to in that it for was on with as be by this are at from"
    text = f"{plain} idiot clown stupid loser idiot moron clown pathetic {plain}"
    row = toxicity.judge(spark.createDataFrame([(1, text), (2, plain)], "doc_id long, text string"), model).collect()
    assert row[0].toxicity.score >= toxicity.CUT > row[1].toxicity.score
    assert any(p["first"] >= 16 and p["end"] <= 28 for p in row[0].toxicity.passages)


def test_without_labels_nothing_is_toxic(spark, edge, tables):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(edge, none) is None
    one = spark.createDataFrame([(i, 1) for i in range(9)], "doc_id long, toxic int")
    assert toxicity.fit(edge, one) is None
    assert toxicity.without_toxic(edge, None).count() == edge.count()
    assert {r.toxicity.score for r in toxicity.judge(edge, None).collect()} == {0.0}


def test_a_word_again_never_counts_for_less():
    """Its n-th time in a row counts an n-th; ordinary words count as ever."""
    known = toxicity.Lexicon(lambda token: ({"bad": 3.0}.get(token, -0.5),), "d")
    assert toxicity.scored("a bad bad bad b b bad".split(), known).tolist() == [-0.5, 3.0, 1.5, 1.0, -0.5, -0.5, 3.0]
    assert toxicity.scored([], known).tolist() == []
    best = [sum(x[0] for x in toxicity.segments(toxicity.scored(["a"] * 9 + ["bad"] * n + ["a"] * 9, known))) for n in (1, 2, 100)]
    assert best == sorted(best) and best[0] < best[1] < best[2]
