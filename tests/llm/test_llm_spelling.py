from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest

from sluice.llm import queries, spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(counts, ratio=10):
    out = {}
    for word, n in counts.items():
        near = [w for w in counts if one_edit(w, word)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        form = best if best is not None and counts[best] >= ratio * n else None
        out[word] = (form, n, len(near), counts[form] if form is not None else None)
    roots = {}
    for word in counts:
        end = word
        while out[end][0] is not None:
            end = out[end][0]
        roots[word] = end
    return {(w, f, roots[w], n, k, fn) for w, (f, n, k, fn) in out.items()}


def near_vocabulary(seed, alphabet, size=150):
    """Words around a few middles, one of them with very many neighbours and one head for all."""
    rng = random.Random(seed)
    middles = ["".join(rng.choices(alphabet, k=rng.randint(7, 12))) for _ in range(6)] + [alphabet[0] * 9]
    out = set(middles) | {middles[0][:6] + "".join(rng.choices(alphabet, k=rng.randint(1, 4))) for _ in range(size)}
    for _ in range(size):
        word = rng.choice(middles)
        for _ in range(rng.randint(1, 3)):
            i, c = rng.randrange(len(word) + 1), rng.choice(alphabet)
            word = rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1 :], word[:i] + c + word[i + 1 :]])
        out.add(word)
    return {w: 2 + int(10 ** rng.uniform(0, 4)) for w in sorted(out) if w}


@pytest.mark.parametrize("large", [2, 8, 512])
@pytest.mark.parametrize("alphabet", ["ab", "abcdeßÿ×", "aб漢😀́"])
def test_near_words(spark, large, alphabet):
    counts = near_vocabulary(large, alphabet)
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = [tuple(r) for r in spelling.variants(words, large=large).collect()]
    assert len(found) == len(counts) and set(found) == brute(counts)


def test_short_words_and_chains(spark):
    counts = {"aaa": 5, "aab": 50, "acb": 600, "dcb": 7000, "x": 3, "y": 3, "xy": 30, "": 100}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = {r.word: r for r in spelling.variants(words).collect()}
    assert [found[w].form for w in ("aaa", "aab", "acb", "dcb")] == ["aab", "acb", "dcb", None]
    assert {found[w].root for w in ("aaa", "aab", "acb", "dcb")} == {"dcb"}
    assert (found["x"].form, found["x"].n_near, found["xy"].n_near) == ("xy", 2, 2)
    assert (found[""].root, found[""].n_near) == ("", 0)  # the empty word is near none


def test_blocks_are_small_and_pairs_come_once(spark):
    """Words that differ in one place, under heads and feet that all share."""
    words = [f"commonhead{a}{b}tail" for a in "abcdefghij" for b in "abcdefghij"]
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    places = spelling.blocks(df, 16)
    sizes = places.groupBy("block", "bucket", "head", "foot").count().collect()
    assert all(r["count"] <= 16 or r.bucket - 1 - r.head - r.foot == 0 for r in sizes)
    found = spelling.near_words(df, 16).collect()
    assert len(found) == 100 and {r.n_near for r in found} == {18}


def test_tiles_of_any_size_agree(monkeypatch):
    rng = np.random.default_rng(1)
    words = sorted({"".join(rng.choice(list("ab"), rng.integers(7, 9))) for _ in range(120)})
    sizes = np.array([len(w) for w in words])
    codes, short = spelling.matrix(words, 8), sizes == 7
    whole = set(zip(*map(list, spelling.near_pairs(codes, short, 7, 0, 0, 8))))
    monkeypatch.setattr(spelling, "TILE", 1000)
    assert set(zip(*map(list, spelling.near_pairs(codes, short, 7, 0, 0, 8)))) == whole
    wanted = {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if one_edit(a, b) and len(a) == 7}
    assert whole == {(i, j) for i, j in wanted if len(words[j]) == 8 or i < j}


def brute_vocabulary(rows, thinned=31):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % thinned == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_edge_documents(spark, edge, clashing, nothing, monkeypatch):
    monkeypatch.setattr(spelling, "REMEMBERED", 3)
    extra = [(7, "Größtes GRÖßtes grÖßtes naïveté naïveté naïvetés _underscored_ undëŕscored", "de", "a", 1)] * 3
    df = edge.unionByName(spark.createDataFrame(extra, edge.schema))
    rows = [(r.doc_id, r.text) for r in df.collect()]
    for thinned in (31, 2):
        found = spelling.vocabulary(df, thinned=thinned).collect()
        assert {r.word: r.n for r in found} == brute_vocabulary(rows, thinned)
    whole = spelling.vocabulary(df).collect()
    assert {r.word: r.n for r in whole} == brute_vocabulary(rows, 1 << 40)
    assert any(len(r.word) == 50_000 for r in spelling.vocabulary(edge.unionAll(edge)).collect())
    other = clashing("word", "n", "block", "at")
    assert spelling.variants(spelling.vocabulary(other)).columns == "word form root n n_near form_n".split()
    assert spelling.variants(spelling.vocabulary(nothing)).collect() == []


def test_documents(spark, tables, sf_dir):
    found = queries.op12_spelling(spark, sf_dir)
    rows = Counter(map(tuple, found.collect()))
    counts = brute_vocabulary([(r.doc_id, r.text) for r in tables("documents", "sf0.01").collect()])
    assert {r[0]: r[3] for r in rows} == counts
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir, 'documents.parquet')}'")
    wanted = connection.sql(f"SELECT {', '.join(found.columns)} FROM ({spelling.SQL})").fetchall()
    assert rows == Counter(wanted) and any(r[1] for r in rows)
