from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import rules

TABLE = rules.class_table()
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines, seen, again = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))


@settings(deadline=None, max_examples=300)
@given(st.text(st.sampled_from("ab#|\n\r \té😀 \x1c"), max_size=60))
def test_base_counts(text):
    assert rules.counted(text, TABLE)[:5] == brute(text)


def test_many_distinct_words(monkeypatch):
    ids = np.array([0, 1, 2, 0, 1, 2, 3, 2, 1, 0])
    assert rules.repeated(ids, 4) == rules.repeated(ids, 2_000_001) == 6


def test_edge_documents(edge, clashing, nothing):
    rows = rules.judge(edge).collect()
    wanted = Counter((r.doc_id, *brute(r.text)) for r in edge.collect())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    assert Counter((r.doc_id, *(r[n] for n in names)) for r in rows) == wanted
    for r in rows:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert rules.judge(nothing).collect() == []
    assert rules.judge(clashing("n_words", "chars", "common", "kept")).count() == len(rows)


def test_distance():
    p, q = np.array([[1.0, 1, 0], [0, 0, 4], [2, 2, 0]]), np.array([5.0, 5, 0])
    assert rules.distance(p, q) == pytest.approx([0, 1, 0])
    half = rules.distance(np.array([[1.0, 0]]), np.array([1.0, 1]))[0]
    assert half**2 == pytest.approx(0.5 * np.log2(1 / 0.75) + 0.5 * (0.5 * np.log2(0.5 / 0.75) + 0.5 * np.log2(0.5 / 0.25)))


def test_junk_goes_and_prose_stays(tables):
    docs = tables("documents", "sf0.1")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = rules.judge(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars) for r in rows) == Counter((i, *brute(t)[:2]) for i, t in texts.items())
    passed = [r for r in rows if not r.base_failed]
    symbols = [r for r in passed if r.n_symbols > 0.5 * r.n_words and r.n_words > 100]
    assert len(symbols) > 100 and sum(r.kept for r in symbols) < 0.4 * len(symbols)
    good = {r.doc_id for r in tables("labels", "sf0.1").where("quality = 1").collect()}
    kept = [r.kept for r in passed if r.doc_id in good]
    assert sum(kept) > 0.995 * len(kept)


def test_without_a_reference_the_base_rules_decide(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(99)), "xx"), (2, "a b", None)], "doc_id long, text string, lang string")
    assert {r.doc_id: (r.kept, r.closest) for r in rules.judge(docs).collect()} == {1: (True, None), 2: (False, None)}


def test_clean_text_of_other_languages_is_left_to_the_base_rules(spark, tables):
    """Held against references of four languages, another script looks like junk."""
    rng = np.random.default_rng(2)
    cyrillic = ["".join(rng.choice(list("абвгдежзиклмнопрстуя"), rng.integers(2, 9))) for _ in range(300)]
    rows = [(-i, " ".join(rng.choice(cyrillic, 200)) + ".", lang) for i, lang in enumerate(["ru", None, "ru", "en"], 1)]
    own = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = own.unionByName(tables("documents", "sf0.01").select("doc_id", "text", "lang"))
    found = {r.doc_id: r for r in rules.judge(docs).where("doc_id < 0").collect()}
    assert [found[-i].kept for i in (1, 2, 3, 4)] == [True, True, True, False]
    assert found[-1].char_distance > rules.CHAR_LIMIT
