from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import phrases, queries

DOCS = "doc_id long, lang string, text string"


def brute_counts(rows, longest):
    counts = defaultdict(Counter)
    for lang, text in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts["und" if lang is None else lang][tuple(words[i : i + size])] += 1
    return counts


def brute(rows, least=10, longest=3, share=50, top=2000):
    out = []
    for lang, f in brute_counts(rows, longest).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        wanted, found = {p: c for p, c in f.items() if len(p) > 1 and c >= least}, []
        for p, a in wanted.items():
            cuts = [(10**6 * a * a // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            inside = [
                q for q, b in wanted.items()
                if len(q) > len(p) and 100 * b >= share * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            ]
            if not inside:
                found.append((score, a, " ".join(p), f[p[:k]], f[p[k:]]))
        found.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, i + 1, p, a, l, r, n, s) for i, (s, a, p, l, r) in enumerate(found[:top])]
    return out


def corpus(seed, docs=60):
    """Few words, some of them frequent late or in one language only; copies; marks and blanks of all kinds."""
    rng = random.Random(seed)
    pool = ["a", "B", "b", "the", "Größe", "é", "x y", "漢", "new", "york", "city", "-", "q" * 30]
    out = []
    for i in range(docs):
        words = rng.choices(pool, range(len(pool), 0, -1), k=rng.randint(0, 60))
        if rng.random() < 0.3:
            words += ["New", "York", "City"] * rng.randint(1, 3)
        gaps = rng.choices([" ", "  ", "\t", ", ", ".", "\n", " \r\n", "\x0b", " "], [30, 2, 2, 3, 2, 1, 1, 1, 30], k=len(words))
        text = "".join(w + g for w, g in zip(words, gaps))
        out += [(i, rng.choice(["en", "en", "en", "de", None, "", "und"]), text)] * rng.choice([1, 1, 1, 3])
    return out


@pytest.mark.parametrize(
    "shards, longest, cells, at_once",
    [(1, 3, 1 << 24, 1 << 21), (2, 3, 1 << 24, 1), (3, 4, 1 << 16, 500), (5, 3, 4, 5000), (4, 2, 64, 250)],
)
def test_equals_brute_force(spark, shards, longest, cells, at_once):
    rows = corpus(shards)
    df = spark.createDataFrame(rows, DOCS)
    scans = dict(shards=shards, cells=cells, at_once=at_once)
    found = phrases.collocations(df, least=4, longest=longest, top=None, **scans).collect()
    wanted = brute([r[1:] for r in rows], 4, longest, top=None)
    assert Counter(map(tuple, found)) == Counter(wanted) and wanted


def test_the_first_of_each_language_with_another_share(spark):
    rows = corpus(9)
    found = phrases.collocations(spark.createDataFrame(rows, DOCS), least=4, share=101, top=3).collect()
    assert Counter(map(tuple, found)) == Counter(brute([r[1:] for r in rows], 4, 3, 101, 3))


def test_a_phrase_is_counted_one_cycle_from_when_its_parts_are_frequent(spark):
    df = spark.createDataFrame([(i, "en", "x y z") for i in range(400)], DOCS)
    shards = df.groupBy(F.pmod(F.xxhash64(*df.columns), F.lit(4)).alias("s")).count().collect()
    assert min(r["count"] for r in shards) > 10 and len(shards) == 4
    found = {r.phrase: r.n for r in phrases.counted(df, shards=4).collect()}
    assert found == {"": 1200} | {p: 400 for p in ("x", "y", "z", "x y", "y z", "x y z")}


@pytest.mark.parametrize("cells, shards", [(256, 3), (1024, 3), (256, 2)])
def test_a_shared_cell_loses_no_scan_of_a_phrase_of_late_words(spark, cells, shards):
    """Rare words become frequent after the first scan, when the cells of their phrases may be taken."""
    rng, rows = random.Random(1), []
    for p in range(80):
        for _ in range(rng.randint(10, 16)):
            rest = rng.choices(["the", "of", "and", "is"], k=5)
            rows.append((len(rows), "en", f"x{p} y{p} z{p} the. {' '.join(rest)}"))
    found = phrases.collocations(spark.createDataFrame(rows, DOCS), cells=cells, shards=shards).collect()
    assert Counter(map(tuple, found)) == Counter(brute([r[1:] for r in rows]))


def test_cells_are_the_same_in_python_and_in_spark(spark):
    chunk = phrases.Chunk()
    chunk.add("en", "ä b ä c".encode())
    ids, _, _, forms, between = chunk.numbered()
    hashes = forms[ids[~between[ids]]]
    pairs = phrases.mixed(hashes[:-1], hashes[1:])
    born = np.arange(1 << 20)
    found = spark.createDataFrame([("en", p) for p in ("ä", "b", "ä", "c", "ä b", "b ä", "ä c")], "lang string, phrase string")
    cells = [r.c for r in found.select(phrases.cell_of(F.col("lang"), F.col("phrase"), 3, 1 << 20).alias("c")).collect()]
    assert cells == [*phrases.born_in(born, hashes).tolist(), *phrases.born_in(born, pairs).tolist()]


def test_exact_beyond_64_bits(spark):
    big = 3_000_000_007
    rows = [("en", p, n) for p, n in [("a", big + 1), ("b", big + 2), ("a b", big), ("c", 10**15), ("a c", big), ("b c", 7)]]
    found = phrases.scored(spark.createDataFrame(rows, "lang string, phrase string, n long")).collect()
    score = {r.phrase: r.score for r in found}
    assert score["a b"] == 10**6 * big * big // ((big + 1) * (big + 2)) == 999_999
    assert score["a c"] == 10**6 * big * big // ((big + 1) * 10**15) and score["b c"] == 0


def test_edge_documents(spark, edge, clashing, nothing):
    df = clashing("phrase", "n", "start", "score", "rank", "a", "l", "r")
    rows = [(r.lang, r.text) for r in edge.collect()]
    found = phrases.collocations(df, least=2).collect()
    assert Counter(map(tuple, found)) == Counter(brute(rows, 2)) and found
    assert phrases.collocations(nothing).collect() == []
    assert phrases.collocations(edge.where("text IS NULL OR text = ''"), least=1).collect() == []
    kinds = df.withColumn("m", F.create_map(F.lit("k"), F.lit(1))).withColumn("s", F.struct("text", "m"))
    assert phrases.collocations(kinds, least=2).count() == len(found)
    with pytest.raises(ValueError, match="below 255"):
        phrases.counted(df, shards=100)


def test_documents(spark, tables, sf_dir):
    found = queries.op11_phrases(spark, sf_dir)
    rows = Counter(map(tuple, found.collect()))
    docs = [(r.lang, r.text) for r in tables("documents", "sf0.01").collect()]
    assert rows == Counter(brute(docs))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{Path(sf_dir, 'documents.parquet')}'")
    assert rows == Counter(connection.sql(f"SELECT {', '.join(found.columns)} FROM ({phrases.SQL})").fetchall())
