from __future__ import annotations

import numpy as np
import pytest

from sluice.llm import quality
from sluice.llm.queries import op4_quality


def test_accuracy_on_held_out_rows(spark, tables):
    rows = op4_quality(spark, "/root/testdata/sf0.1").join(tables("labels", "sf0.1"), "doc_id").where("held_out")
    seen = {(r.quality, r.predicted): r["count"] for r in rows.groupBy("quality", "predicted").count().collect()}
    total = sum(seen.values())
    assert total > 1000 and (seen.get((1, 1), 0) + seen.get((0, 0), 0)) / total > 0.98


def test_ngrams_of_a_text():
    known = quality.lexicon()
    words = ("Word", "a1b", "x###", "|", "É!!", "漢字")
    assert [quality.shape_of(w) for w in words] == ["Aa", "a0a", "a#", "|", "A!", "c"]
    once, twice = quality.cells_of("one two", known), quality.cells_of("one two one two one", known)
    assert set(once) < set(twice)
    assert len(quality.cells_of(None, known)) == len(quality.cells_of(" \n", known)) == 0
    assert len(quality.cells_of("a a a a a a", known)) == len(quality.cells_of("a a a a a a a a a", known))


def test_a_full_lexicon_is_emptied_between_texts():
    text = " ".join(f"w{i % 70} x{i}" for i in range(300))
    known = quality.lexicon()
    small = quality.Lexicon(quality.hashes_of, "QQ", most=10)
    for _ in range(3):
        assert (quality.cells_of(text, known) == quality.cells_of(text, small)).all()


def test_ratios():
    rows = [np.array([1, 2]), np.array([2, 3]), np.array([3])]
    found = quality.ratios(rows, np.array([1, 1, 0]))
    total = np.array([quality.CELLS + 1, quality.CELLS + 4])
    assert found[2] == pytest.approx(np.log((3 / total[1]) / (1 / total[0])))
    assert found[3] == pytest.approx(np.log((2 / total[1]) / (2 / total[0])))


def test_coordinate_descent_solves_the_dual():
    """At the optimum no step can improve: what the gap leaves is all there is to gain."""
    chance = np.random.default_rng(3)
    rows = [np.sort(chance.choice(30, 5, replace=False)) for _ in range(40)]
    signs = np.where(chance.random(40) < 0.5, 1.0, -1.0)
    values = [chance.normal(size=5) for _ in rows]
    weights, bias = quality.descend(rows, values, signs)

    def loss(w, b):
        cost = np.where(signs > 0, 1 / (signs > 0).mean(), 1 / (signs < 0).mean()) / 2
        margins = np.array([s * (w[r] @ v + b) for r, v, s in zip(rows, values, signs)])
        return (w @ w + b * b) / 2 + (cost * np.maximum(1 - margins, 0)).sum()

    best = loss(weights, bias)
    for _ in range(300):
        step = np.zeros_like(weights)
        step[:30] = chance.normal(size=30) * 10 ** -chance.uniform(1, 5)
        assert loss(weights + step, bias + chance.normal() * 1e-3) >= best * (1 - quality.GAP)


def test_edge_documents(spark, edge, clashing, nothing, tables):
    model = quality.fit(tables("documents", "sf0.01"), tables("labels", "sf0.01"))
    rows = quality.judge(edge, model).collect()
    assert len(rows) == edge.count() and all(0 <= r.quality <= 1 for r in rows)
    assert len({r.quality for r in rows if not (r.text or "").strip(" \n\t\r\x0b\x0c")}) == 1
    assert quality.judge(clashing("Quality"), model).columns[-1] == "quality_"
    assert quality.judge(nothing, model).collect() == []
    assert quality.fit(edge, spark.createDataFrame([], "doc_id long, quality int")) is None
    assert {r.quality for r in quality.judge(edge, None).collect()} == {0.5}


def test_descent_goes_on_until_the_gap_is_closed(monkeypatch):
    """Rows that are hard to tell apart take more than twenty rounds."""
    chance = np.random.default_rng(4)
    rows = [np.sort(chance.choice(12, 6, replace=False)) for _ in range(300)]
    signs = np.where(chance.random(300) < 0.5, 1.0, -1.0)
    values = [chance.normal(size=6) for _ in rows]

    def loss(w, b):
        cost = np.where(signs > 0, 1 / (signs > 0).mean(), 1 / (signs < 0).mean()) / 2
        margins = np.array([s * (w[r] @ v + b) for r, v, s in zip(rows, values, signs)])
        return (w @ w + b * b) / 2 + (cost * np.maximum(1 - margins, 0)).sum()

    found = loss(*quality.descend(rows, values, signs))
    monkeypatch.setattr(quality, "GAP", 1e-9)
    assert found <= loss(*quality.descend(rows, values, signs)) * (1 + 2e-4)
